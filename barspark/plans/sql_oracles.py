"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics in the blueprint, not from the Spark code: plain windows over
``PARTITION BY ticker ORDER BY date``, recursive CTEs for the EMA recursions and the promotion
fold, ASOF joins for the nearest bar.  Tables are the pre-registered views over the test data.
"""

from __future__ import annotations

# --- bar adapters ---------------------------------------------------------------------------

BARS = """
bars AS (
  SELECT event_type AS ticker, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS volume,
         min(event_id) AS arrival
  FROM events GROUP BY 1, 2)"""

SBARS = """
sbars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS TIMESTAMP) AS date,
         arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""


def window_features(src: str = "bars", name: str = "wf") -> str:
    """All rolling features of V1/V2 (not dropped), one row per bar."""
    return f"""
{name}_r AS (
  SELECT *, (close - lag(close) OVER w) / NULLIF(lag(close) OVER w, 0) AS r1,
         close - lag(close) OVER w AS d
  FROM {src} WINDOW w AS (PARTITION BY ticker ORDER BY date)),
{name} AS (
  SELECT ticker, date, open, high, low, close, volume,
    r1 AS return_1d,
    (close - lag(close, 5) OVER w) / NULLIF(lag(close, 5) OVER w, 0) AS return_5d,
    (close - lag(close, 20) OVER w) / NULLIF(lag(close, 20) OVER w, 0) AS return_20d,
    CASE WHEN count(r1) OVER w5 = 5 THEN stddev_samp(r1) OVER w5 END AS volatility_5d,
    CASE WHEN count(r1) OVER w20 = 20 THEN stddev_samp(r1) OVER w20 END AS volatility_20d,
    CASE WHEN count(d) OVER w14 = 14 THEN
      CASE WHEN avg(greatest(-d, 0)) OVER w14 = 0 THEN 100.0
           ELSE 100.0 - 100.0 / (1.0 + avg(greatest(d, 0)) OVER w14 / avg(greatest(-d, 0)) OVER w14) END
    END AS rsi_14,
    CASE WHEN count(volume) OVER w20 = 20 THEN volume / NULLIF(avg(volume) OVER w20, 0) END AS volume_ratio_20d
  FROM {name}_r
  WINDOW w AS (PARTITION BY ticker ORDER BY date),
    w5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w14 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


def ema_recursive(src: str = "bars", name: str = "em") -> str:
    """Full-history EMA12/EMA26/signal9 by recursion over the row number (needs WITH RECURSIVE)."""
    a12, a26, a9 = "(2.0 / 13.0)", "(2.0 / 27.0)", "(2.0 / 10.0)"
    e12 = f"(e.e12 * (1.0 - {a12}) + ix.close * {a12})"
    e26 = f"(e.e26 * (1.0 - {a26}) + ix.close * {a26})"
    return f"""
{name}_ix AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM {src}),
{name}_rec(ticker, i, e12, e26, sig) AS (
  SELECT ticker, i, close, close, CAST(0.0 AS DOUBLE) FROM {name}_ix WHERE i = 1
  UNION ALL
  SELECT ix.ticker, ix.i, {e12}, {e26}, e.sig * (1.0 - {a9}) + ({e12} - {e26}) * {a9}
  FROM {name}_rec e JOIN {name}_ix ix ON ix.ticker = e.ticker AND ix.i = e.i + 1),
{name} AS (
  SELECT ix.ticker, ix.date, ix.close, r.e12 AS ema_12, r.e26 AS ema_26, r.e12 - r.e26 AS macd, r.sig AS macd_signal
  FROM {name}_ix ix JOIN {name}_rec r ON r.ticker = ix.ticker AND r.i = ix.i)"""


def ema_window_recursive(src: str = "bars", name: str = "mw", window: int = 100) -> str:
    """MACD signal over the last ``window`` rows only, seeded at each window's first row."""
    a12, a26, a9 = "(2.0 / 13.0)", "(2.0 / 27.0)", "(2.0 / 10.0)"
    e12 = f"(e.e12 * (1.0 - {a12}) + ix.close * {a12})"
    e26 = f"(e.e26 * (1.0 - {a26}) + ix.close * {a26})"
    return f"""
{name}_ix AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i FROM {src}),
{name}_rec(ticker, last_i, i, e12, e26, sig) AS (
  SELECT ticker, i + {window - 1}, i, close, close, CAST(0.0 AS DOUBLE) FROM {name}_ix
  UNION ALL
  SELECT ix.ticker, e.last_i, ix.i, {e12}, {e26}, e.sig * (1.0 - {a9}) + ({e12} - {e26}) * {a9}
  FROM {name}_rec e JOIN {name}_ix ix ON ix.ticker = e.ticker AND ix.i = e.i + 1 AND e.i < e.last_i),
{name} AS (
  SELECT ix.ticker, ix.date, r.sig AS macd_signal_window
  FROM {name}_ix ix LEFT JOIN {name}_rec r ON r.ticker = ix.ticker AND r.last_i = ix.i AND r.i = ix.i)"""


def labels(src: str = "bars", name: str = "lb", n: int = 5) -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN lead(close, {n}) OVER w IS NOT NULL THEN CAST(lead(close, {n}) OVER w > close AS INTEGER) END AS label
  FROM {src} WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


V1 = ["return_1d", "return_5d", "volatility_5d", "volatility_20d", "rsi_14", "volume_ratio_20d"]
V2 = ["return_1d", "return_5d", "return_20d", "volatility_5d", "volatility_20d", "rsi_14", "volume_ratio_20d", "macd_signal"]


def r6(cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in cols)


def not_null(cols: list[str], prefix: str = "") -> str:
    return " AND ".join(f"{prefix}{c} IS NOT NULL" for c in cols)


FEATURES_V2_TABLE = f"""
fv2 AS (
  SELECT wf.ticker, wf.date, {", ".join("wf." + c for c in V2[:-1])}, em.macd_signal
  FROM wf JOIN em ON em.ticker = wf.ticker AND em.date = wf.date
  WHERE {not_null(V2[:-1], "wf.")} AND em.macd_signal IS NOT NULL)"""

TRAINING_SET = f"""
ts AS (
  SELECT lb.ticker, lb.date, lb.label, {", ".join("fv2." + c for c in V2)}
  FROM lb JOIN fv2 ON fv2.ticker = lb.ticker AND fv2.date = lb.date
  WHERE lb.label IS NOT NULL)"""

TRAINING_BASE = "WITH RECURSIVE " + ",".join([BARS, window_features(), ema_recursive(), labels(), FEATURES_V2_TABLE, TRAINING_SET])

SPLIT = "TIMESTAMP '2024-01-21 00:00:00'"

STATS = (
    "st AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std FROM ts WHERE date < {SPLIT}" for c in V2
    )
    + ")"
)


def drift_case(c: str) -> str:
    return (
        f"CASE WHEN (SELECT std FROM st WHERE feature = '{c}') IS NOT NULL AND (SELECT std FROM st WHERE feature = '{c}') <> 0 "
        f"AND NOT isnan({c}) AND abs({c} - (SELECT mean FROM st WHERE feature = '{c}')) / (SELECT std FROM st WHERE feature = '{c}') > 3.0 "
        f"THEN '{c}' END"
    )


DRIFT = f"""
dr AS (
  SELECT ticker, date, concat_ws(',', {", ".join(drift_case(c) for c in V2)}) AS drifted_features,
         CAST({" + ".join(f"CASE WHEN ({drift_case(c)}) IS NULL THEN 0 ELSE 1 END" for c in V2)} AS BIGINT) AS n_drifted
  FROM ts WHERE date >= {SPLIT})"""

# prediction log derived from bars (see FIXTURES part 2)
LOG = """
bx AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS pos,
              (close - lag(close) OVER (PARTITION BY ticker ORDER BY date)) / NULLIF(lag(close) OVER (PARTITION BY ticker ORDER BY date), 0) AS r1
       FROM bars),
plog AS (
  SELECT CASE WHEN pos % 97 = 0 THEN ticker || '_unlisted' ELSE ticker END AS ticker,
         CASE WHEN pos % 50 = 0 THEN NULL ELSE strftime(date + INTERVAL 30 MINUTE * CAST(pos % 4 AS INTEGER), '%Y-%m-%d %H:%M:%S') END AS prediction_date,
         CASE WHEN r1 > 0 THEN 'UP' ELSE 'DOWN' END AS direction,
         CAST((pos * 37) % 100 AS DOUBLE) / 100.0 AS probability,
         CAST(pos % 3 AS VARCHAR) AS model_version
  FROM bx WHERE r1 IS NOT NULL)"""

EVAL = """
bi AS (SELECT ticker, date, close, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY ticker) AS n_bars,
              lead(close, 5) OVER w AS close_fwd
       FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
pl AS (SELECT *, CAST(prediction_date AS TIMESTAMP) AS t FROM plog),
prv AS (SELECT pl.*, b.idx AS p_idx, b.date AS p_date, b.close AS p_close, b.close_fwd AS p_fwd
        FROM pl ASOF LEFT JOIN bi b ON pl.ticker = b.ticker AND pl.t >= b.date),
nxt AS (SELECT prv.*, b.idx AS n_idx, b.date AS n_date, b.close AS n_close, b.close_fwd AS n_fwd
        FROM prv ASOF LEFT JOIN (SELECT * FROM bi) b ON prv.ticker = b.ticker AND prv.t < b.date),
ch AS (
  SELECT nxt.*,
    (n_date IS NOT NULL AND (p_date IS NULL OR epoch_us(n_date) - epoch_us(t) <= epoch_us(t) - epoch_us(p_date))) AS take_next
  FROM nxt),
ev AS (
  SELECT ch.ticker, ch.prediction_date, ch.direction, ch.probability, ch.model_version,
    CASE WHEN take_next THEN n_idx ELSE p_idx END AS bar_index,
    CASE WHEN take_next THEN n_date ELSE p_date END AS bar_date,
    CASE WHEN take_next THEN n_close ELSE p_close END AS c_t,
    CASE WHEN take_next THEN n_fwd ELSE p_fwd END AS c_f,
    (SELECT max(n_bars) FROM bi WHERE bi.ticker = ch.ticker) AS n_bars
  FROM ch),
st2 AS (
  SELECT *, CASE WHEN prediction_date IS NULL OR trim(prediction_date) = '' OR n_bars IS NULL THEN 'skipped'
                 WHEN bar_index + 5 >= n_bars THEN 'pending' ELSE 'evaluated' END AS status
  FROM ev),
res AS (
  SELECT *, CASE WHEN status = 'evaluated' THEN CASE WHEN c_f > c_t THEN 'UP' ELSE 'DOWN' END END AS realized
  FROM st2)"""

LOG_BASE = "WITH " + ",".join([BARS, LOG])
EVAL_BASE = "WITH " + ",".join([BARS, LOG, EVAL])

SCORED = """
sc AS (
  SELECT ticker, date, label, round(1.0 / (1.0 + exp(-100.0 * r1)), 2) AS score,
         CAST(round(1.0 / (1.0 + exp(-100.0 * r1)), 2) >= 0.5 AS INTEGER) AS prediction
  FROM (SELECT *, (close - lag(close) OVER w) / NULLIF(lag(close) OVER w, 0) AS r1,
               CASE WHEN lead(close, 5) OVER w IS NOT NULL THEN CAST(lead(close, 5) OVER w > close AS INTEGER) END AS label
        FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))
  WHERE r1 IS NOT NULL AND label IS NOT NULL)"""

RUNS = """
runs AS (
  SELECT model || '-' || strftime(day, '%Y%m%d') AS run_id, model,
         CAST(day - DATE '1970-01-01' AS BIGINT) AS run_seq,
         0.5 + CAST(cents % 997 AS DOUBLE) / 19940.0 AS roc_auc
  FROM (SELECT event_type AS model, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM events GROUP BY 1, 2)),
rv AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY run_seq, run_id) AS version FROM runs),
fold(model, version, run_id, run_seq, roc_auc, promoted, champion_version, champion_auc) AS (
  SELECT model, version, run_id, run_seq, roc_auc, TRUE, version, roc_auc FROM rv WHERE version = 1
  UNION ALL
  SELECT r.model, r.version, r.run_id, r.run_seq, r.roc_auc,
         (NOT isnan(r.roc_auc - f.champion_auc) AND r.roc_auc - f.champion_auc >= 0.005),
         CASE WHEN NOT isnan(r.roc_auc - f.champion_auc) AND r.roc_auc - f.champion_auc >= 0.005 THEN r.version ELSE f.champion_version END,
         CASE WHEN NOT isnan(r.roc_auc - f.champion_auc) AND r.roc_auc - f.champion_auc >= 0.005 THEN r.roc_auc ELSE f.champion_auc END
  FROM fold f JOIN rv r ON r.model = f.model AND r.version = f.version + 1)"""

RUNS_BASE = "WITH RECURSIVE " + RUNS


def boosted_trees(features: list[str], columns: list[list[str]], depth: int, bins: int, rate: float, rows: float, seed: int, ridge: float, min_hessian: float) -> str:
    """CTEs ``nd`` (nodes) and ``ls`` (log loss of the test rows) of boosted trees over ``ts``, one tree per list of ``columns``.

    Every level sums gradients and hessians by (node, feature, bin) over plain joins; leaves sum the rows they hold.
    """
    x = ", ".join(f"round({c}, 6) AS {c}" for c in features)
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in features)
    # an edge is written once per value, as a set of them would be
    cut = " UNION ALL ".join(
        f"SELECT id, {i} AS f, CASE WHEN hi_{c} > lo_{c} THEN len(list_distinct([lo_{c} + (hi_{c} - lo_{c}) * k / {bins} FOR k IN range(1, {bins}) "
        f"IF {c} >= lo_{c} + (hi_{c} - lo_{c}) * k / {bins}])) ELSE 0 END AS b FROM bx0, be"
        for i, c in enumerate(features)
    )
    ctes = [
        f"bx0 AS (SELECT ticker || '|' || CAST(epoch_us(date) AS VARCHAR) AS id, date < {SPLIT} AS train, CAST(label AS DOUBLE) AS y, {x} FROM ts)",
        f"be AS (SELECT {ends} FROM bx0 WHERE train)",
        f"bb AS MATERIALIZED ({cut})",
        "m0 AS (SELECT id, train, y, CAST(0 AS DOUBLE) AS margin FROM bx0)",
    ]
    nodes, losses = [], []
    for t, own in enumerate(columns):
        chosen = ", ".join(str(features.index(c)) for c in own)
        ctes.append(
            f"g{t} AS MATERIALIZED (SELECT id, y, train AND CAST('0x' || substr(md5(id || '|{t}|{seed}'), 1, 8) AS BIGINT) < {int(rows * (1 << 32))} AS drawn, "
            f"1.0 / (1.0 + exp(-margin)) - y AS g, greatest(1.0 / (1.0 + exp(-margin)) * (1 - 1.0 / (1.0 + exp(-margin))), 1e-16) AS h FROM m{t})"
        )
        ctes.append(f"n{t}_0 AS (SELECT id, 1 AS node FROM g{t})")
        for level in range(depth):
            n = f"n{t}_{level}"
            ctes.append(
                f"h{t}_{level} AS (SELECT node, f, b, sum(g) AS g, sum(h) AS h FROM {n} JOIN g{t} USING (id) JOIN bb USING (id) "
                f"WHERE drawn AND node >= {2**level} AND f IN ({chosen}) GROUP BY ALL)"
            )
            ctes.append(
                f"c{t}_{level} AS (SELECT node, f, b, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(g) OVER a AS gt, sum(h) OVER a AS ht FROM h{t}_{level} "
                "WINDOW a AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
            )
            ctes.append(
                f"q{t}_{level} AS (SELECT *, gl * gl / (hl + {ridge}) + (gt - gl) * (gt - gl) / (ht - hl + {ridge}) - gt * gt / (ht + {ridge}) AS gain FROM c{t}_{level})"
            )
            ctes.append(
                f"s{t}_{level} AS MATERIALIZED (SELECT * FROM q{t}_{level} WHERE hl >= {min_hessian} AND ht - hl >= {min_hessian} AND gain > 0 "
                "QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, b) = 1)"
            )
            ctes.append(
                f"n{t}_{level + 1} AS MATERIALIZED (SELECT {n}.id, CASE WHEN s.node IS NULL THEN {n}.node ELSE 2 * {n}.node + CAST(bb.b > s.b AS INTEGER) END AS node "
                f"FROM {n} LEFT JOIN s{t}_{level} s ON s.node = {n}.node LEFT JOIN bb ON bb.id = {n}.id AND bb.f = s.f)"
            )
            names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(features)) + " END"
            nodes.append(f"SELECT {t} AS tree, node, {names} AS feature, CAST(b AS INTEGER) AS cut, gain, ht AS hessian, NULL AS weight FROM s{t}_{level}")
        ctes.append(f"w{t} AS (SELECT node, -{rate} * sum(g) / (sum(h) + {ridge}) AS weight, sum(h) AS hessian FROM n{t}_{depth} JOIN g{t} USING (id) WHERE drawn GROUP BY node)")
        nodes.append(f"SELECT {t} AS tree, node, NULL AS feature, NULL AS cut, NULL AS gain, hessian, weight FROM w{t}")
        ctes.append(f"m{t + 1} AS MATERIALIZED (SELECT m.id, train, y, margin + weight AS margin FROM m{t} m JOIN n{t}_{depth} USING (id) JOIN w{t} USING (node))")
        losses.append(f"SELECT {t} AS tree, avg(ln(1 + exp(-abs(margin))) + greatest(margin, 0) - y * margin) AS log_loss FROM m{t + 1} WHERE NOT train")
    ctes += [f"nd AS ({' UNION ALL '.join(nodes)})", f"ls AS ({' UNION ALL '.join(losses)})"]
    return ", ".join(ctes)
