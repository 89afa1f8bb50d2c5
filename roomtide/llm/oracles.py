"""DuckDB SQL with the same results as registered queries of this subpackage, written independently."""

from __future__ import annotations


def product_codes(rounds: int = 4) -> str:
    """Codes, errors and codebooks in long form: a row for every component of every part."""
    ctes = ["""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, w) AS r, *
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS w
        FROM embeddings
        WHERE len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)))""",
            "dim AS (SELECT len(w) AS d, (len(w) + 3) // 4 AS width FROM kept WHERE r = 1)",
            """parts AS MATERIALIZED (
  SELECT r, (i - 1) // width AS p, (i - 1) % width AS j, w[i] AS x
  FROM (SELECT r, w, width, unnest(range(1, d + 1)) AS i FROM kept, dim WHERE len(w) = d))""",
            """books0 AS MATERIALIZED (
  SELECT p, dense_rank() OVER (ORDER BY r) - 1 AS e, j, x AS c FROM parts
  WHERE r IN (SELECT DISTINCT r FROM parts ORDER BY r LIMIT 256))"""]
    for k in range(rounds + 1):
        ctes.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, min(far * 256 + e) % 256 AS e, min(far * 256 + e) // 256 AS far
  FROM (SELECT r, p, e, sum((x - c) * (x - c))::BIGINT AS far FROM parts JOIN books{k} USING (p, j) GROUP BY ALL)
  GROUP BY r, p)""")
        if k < rounds:
            ctes.append(f"""books{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce(m.c, b.c) AS c FROM books{k} b LEFT JOIN (
    SELECT p, e, j, floor(sum(x)::DOUBLE / count(*))::BIGINT AS c FROM parts JOIN near{k} USING (r, p) GROUP BY ALL) m
  USING (p, e, j))""")
    return f"""WITH {', '.join(ctes)},
coded AS (
  SELECT r, string_agg(printf('%02x', e::INT), '' ORDER BY p) AS code, sum(far)::BIGINT AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM books{rounds}) AS codebooks_sha256
FROM kept LEFT JOIN coded USING (r)"""


def _uniform(*parts: str) -> str:
    hashed = f"md5(concat_ws('|', {', '.join(parts)}))"
    return f"(('0x' || substr({hashed}, 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE)"


PARETO_MIXTURE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS src, md5(coalesce(text, '')) AS print,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents
),
single AS (
  SELECT *, greatest(length(bin(size)) - 6, 0) AS shift,
    row_number() OVER (PARTITION BY src, doc_id, print) - 1 AS occurrence FROM docs
),
rows_ AS MATERIALIZED (
  SELECT *, CASE WHEN size < 64 THEN size ELSE shift * 64 + (size >> shift) END AS class FROM single
),
sources AS (
  SELECT src, sum(size)::BIGINT AS s,
    [5, 2, 1][((row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM rows_ GROUP BY src
),
filled AS (
  SELECT *, sum(s) OVER upto AS s_upto, sum(w) OVER upto AS w_upto, sum(s) OVER () AS s_all, sum(w) OVER () AS w_all
  FROM sources WINDOW upto AS (ORDER BY s / w, src)
),
rates AS (
  SELECT (s_all - 3 * (s_upto - s))::DOUBLE / (w_all - (w_upto - w)) AS rate
  FROM filled WHERE 3.0::DOUBLE * s >= (s_all - 3 * (s_upto - s))::DOUBLE / (w_all - (w_upto - w)) * w
  ORDER BY s / w, src LIMIT 1
),
targets AS (
  SELECT src, s, least(3.0::DOUBLE * s, rate * w) AS target,
    CASE WHEN s > 0 THEN floor(least(3.0::DOUBLE * s, rate * w) / s)::BIGINT ELSE 0 END AS whole
  FROM sources, rates
),
classes AS (
  SELECT src, class, n, words, row_number() OVER (PARTITION BY src ORDER BY class DESC) AS place,
    {_uniform("'mix-1'", "src", "class::VARCHAR")} AS u,
    CASE WHEN s > 0 THEN (target - whole * s) / s ELSE 0.0 END AS share
  FROM (SELECT src, class, count(*) AS n, sum(size)::BIGINT AS words FROM rows_ GROUP BY ALL) JOIN targets USING (src)
),
drawn AS (
  SELECT src, 0::BIGINT AS place, 0.0::DOUBLE AS carry, NULL::BIGINT AS class, NULL::BIGINT AS n, NULL::BIGINT AS take
  FROM targets
  UNION ALL
  SELECT src, place, wanted - CASE WHEN words > 0 THEN take * mean ELSE 0 END, class, n, take FROM (
    SELECT *, CASE WHEN words > 0 THEN least(greatest(floor(wanted / mean + u)::BIGINT, 0), n) ELSE 0 END AS take FROM (
      SELECT c.*, c.words::DOUBLE / c.n AS mean, c.share * c.words + d.carry AS wanted
      FROM drawn d JOIN classes c ON c.src = d.src AND c.place = d.place + 1))
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src, class ORDER BY
    CASE WHEN take > 0 AND take < n THEN (u / (1 - u)) / ((take::DOUBLE / n) / (1 - take::DOUBLE / n)) ELSE u END,
    u, doc_id, print, occurrence) AS rank
  FROM (SELECT r.*, d.n, d.take,
          {_uniform("'mix-1'", "r.src", "coalesce('d' || doc_id, 'n')", "print", "occurrence::VARCHAR")} AS u
        FROM rows_ r JOIN drawn d USING (src, class))
)
SELECT doc_id, size, s AS source_size, target, size * (whole + (rank <= take)::BIGINT) AS taken,
  whole + (rank <= take)::BIGINT AS copies, source
FROM ranked JOIN targets USING (src)"""

ORACLES: dict[str, str] = {
    "op11_trie_codes": product_codes(),
    "op13_pareto_mixture": PARETO_MIXTURE,
}
