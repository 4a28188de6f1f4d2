"""DuckDB SQL for the text queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

A_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({A_Z}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def raked_mix(targets: dict[str, dict[str, float]], sweeps: int = 80, trim: float = 0.05, short: float = 0.05) -> str:
    """Raking by a fixed number of sweeps (more than it takes to settle), then the rate and the draw.

    The rate is the larger of two: beyond the first, cells stand for at most ``trim`` of all wanted tokens; at the second, every
    category keeps ``1 - short`` of its own.  What a category keeps at rate r is concave in r (cells of smaller scales whole, r
    of the others' tokens), so the least rate is the largest root of its straight pieces.
    """

    def classed(column: str, names: list[str]) -> str:
        return f"CASE WHEN {column} IN ({', '.join(repr(n) for n in names)}) THEN {column} ELSE '*' END"

    wants = " UNION ALL ".join(
        f"SELECT {d} AS d, * FROM (VALUES {', '.join(f'({n!r}, {v!r}::DOUBLE)' for n, v in [*t.items(), ('*', max(0.0, 1 - sum(t.values())))])}) AS t(name, want)"
        for d, t in enumerate(targets.values())
    )

    def step(inner: str, d: int) -> str:
        scaled = f"scale * w{d} * sum(tokens * scale) OVER () / sum(tokens * scale) OVER (PARTITION BY k{d})"
        return f"SELECT n, k0, k1, k2, tokens, w0, w1, w2, {scaled} AS scale FROM ({inner})"

    sweep = step(step(step(f"SELECT * FROM raked WHERE n < {sweeps}", 0), 1), 2)
    share = "(length(text) - length(replace(text, {!s}, ''))) * 1000"
    return f"""
WITH RECURSIVE typed AS (
  SELECT doc_id, text, {classed('source', list(targets['source']))} AS k0, {classed('lang', list(targets['lang']))} AS k1,
    CAST(ceil(strlen(coalesce(text, '')) / 4.0) AS BIGINT) AS tokens,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 'plain'
      WHEN {share.format("','")} >= 10 * length(text) THEN 'clauses'
      WHEN {share.format("'.'")} >= 15 * length(text) THEN 'terse'
      WHEN {share.format("chr(10)")} >= 3 * length(text) THEN 'lines' ELSE 'plain' END AS topic FROM documents),
keyed AS (SELECT *, {classed('topic', list(targets['topic']))} AS k2 FROM typed),
cells AS (SELECT k0, k1, k2, CAST(sum(tokens) AS DOUBLE) AS tokens FROM keyed GROUP BY ALL),
wants AS ({wants}),
held AS (SELECT 0 AS d, k0 AS name FROM cells GROUP BY ALL HAVING sum(tokens) > 0
  UNION ALL SELECT 1, k1 FROM cells GROUP BY ALL HAVING sum(tokens) > 0
  UNION ALL SELECT 2, k2 FROM cells GROUP BY ALL HAVING sum(tokens) > 0),
shares AS (SELECT d, name, want / sum(want) OVER (PARTITION BY d) AS want FROM wants JOIN held USING (d, name)),
start AS (SELECT 0 AS n, k0, k1, k2, tokens, a.want AS w0, b.want AS w1, c.want AS w2, 1::DOUBLE AS scale FROM cells
  JOIN shares a ON a.d = 0 AND a.name = k0 JOIN shares b ON b.d = 1 AND b.name = k1 JOIN shares c ON c.d = 2 AND c.name = k2),
raked AS (SELECT * FROM start UNION ALL SELECT n + 1, k0, k1, k2, tokens, w0, w1, w2, scale FROM ({sweep})),
done AS (SELECT k0, k1, k2, tokens, scale, tokens * scale AS wanted FROM raked WHERE n = {sweeps}),
ranked AS (SELECT *, sum(wanted) OVER () AS total,
  coalesce(sum(wanted) OVER (ORDER BY scale DESC, k0, k1, k2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM done),
cats AS (SELECT unnest([0, 1, 2]) AS d, unnest([k0, k1, k2]) AS name, row_number() OVER () AS i, tokens, scale FROM done),
pieces AS (SELECT {1 - short} * sum(tokens * scale) OVER (PARTITION BY d, name) AS goal,
  coalesce(sum(tokens * scale) OVER (PARTITION BY d, name ORDER BY scale, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
  sum(tokens) OVER (PARTITION BY d, name ORDER BY scale, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM cats),
rate AS (SELECT greatest((SELECT min(scale) FROM ranked WHERE above <= {trim} * total),
  (SELECT coalesce(max((goal - below) / rest), 0) FROM pieces WHERE goal > 0 AND rest > 0)) AS rate),
drawn AS (SELECT keyed.*, least(1.0, coalesce(scale / rate, 0.0)) AS p,
  CAST('0x' || substr(sha256(concat_ws(chr(31), CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM keyed CROSS JOIN rate LEFT JOIN done ON done.k0 = keyed.k0 AND done.k1 = keyed.k1 AND done.k2 = keyed.k2)
SELECT doc_id, k0 AS source, k1 AS lang, k2 AS topic, tokens, round(p, 6) AS probability, u < p AS kept FROM drawn
"""


def gnat_codes(parts: int, entries: int, rounds: int, scale: int, dim: int = 64) -> str:
    """Product codes by comparing every part with every entry (vectors of ``dim`` components, as the given tables hold)."""
    width = dim // parts
    apart = " + ".join(f"(p.x{j} - c.x{j}) * (p.x{j} - c.x{j})" for j in range(width))
    xs = ", ".join(f"x{j}" for j in range(width))
    ctes = [
        "k AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL "
        "AND len([z FOR z IN embedding IF z IS NULL OR NOT isfinite(z)]) = 0)",
        "p AS (SELECT vec_id, label, part, " + ", ".join(f"CAST(floor({scale} * CAST(e[part * {width} + {j + 1}] AS DOUBLE)) AS BIGINT) AS x{j}" for j in range(width))
        + f" FROM k, (SELECT unnest(range({parts})) AS part))",
        f"c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, {xs} FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"a{r} AS (SELECT p.vec_id, p.part, any_value(p.label) AS label, " + ", ".join(f"any_value(p.x{j}) AS x{j}" for j in range(width))
            + f", min(({apart}) * 256 + c.entry) AS near FROM p JOIN c{r} c ON c.part = p.part GROUP BY p.vec_id, p.part)"
        )
        if r < rounds:
            mean = ", ".join(f"coalesce(m.x{j}, c.x{j}) AS x{j}" for j in range(width))
            floor = ", ".join(f"CAST((sum(x{j}) - ((sum(x{j}) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x{j}" for j in range(width))
            ctes.append(f"m{r} AS (SELECT part, near % 256 AS entry, {floor} FROM a{r} GROUP BY ALL)")
            ctes.append(f"c{r + 1} AS (SELECT c.part, c.entry, {mean} FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.entry = c.entry)")
    listed = " || ',' || ".join(f"x{j}" for j in range(width))
    return (
        f"WITH {', '.join(ctes)}, "
        f"books AS (SELECT sha256(string_agg({listed}, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}), "
        f"coded AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', near % 256)), '' ORDER BY part) AS code, CAST(sum(near // 256) AS BIGINT) AS error "
        f"FROM a{rounds} GROUP BY vec_id) "
        "SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"
    )


def fim_frames(seed: int, rate: int = 100, spm: int = 50) -> str:
    """Fill-in-middle on lists of lines."""
    draws = ", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || doc_id) AS h FROM documents),
l AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS lines, {draws} FROM d),
c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {rate} THEN 'plain' WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM l),
s AS (SELECT *, array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:n], '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM s
"""
