"""The same results in SQL (DuckDB dialect), for the document operators that it can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BIT = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


def crc32(text: str) -> str:
    """The unsigned crc32 of a short ASCII text."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1)))"
    byte = f"list_reduce(list_prepend(xor(s, b), range(0, 8)), lambda c, k: {_BIT})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda s, b: {byte}))"


_ID_SUM = crc32("cast(doc_id AS varchar)")

# --- hash trees --------------------------------------------------------------------------------

#: Levels of three digests each that the SQL goes up: enough for 3 ** 14 rows a group, and as many groups.
_UP = 14


def _leaf(text: str) -> str:
    columns = ["cast(doc_id AS varchar)", "source", "lang", "cast(n_chars AS varchar)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


def _climb(name: str, nodes: str, state: str) -> str:
    """CTEs that go up from ``nodes`` (g, r, d, n), and lead ``state`` (with g, r, n, proof, cur) along."""
    out = [f"{name}_n0 AS ({nodes})", f"{name}_s0 AS ({state})"]
    for i in range(_UP):
        out.append(f"""{name}_t{i} AS (SELECT g, r // 3 AS q, list(d ORDER BY r) AS ds, max(n) AS n
            FROM {name}_n{i} GROUP BY g, r // 3)""")
        out.append(f"""{name}_n{i + 1} AS (SELECT g, q AS r, CASE WHEN n > 1 THEN sha256(array_to_string(ds, ''))
            ELSE ds[1] END AS d, (n + 2) // 3 AS n FROM {name}_t{i})""")
        out.append(f"""{name}_s{i + 1} AS (SELECT s.* REPLACE (s.r // 3 AS r, (s.n + 2) // 3 AS n,
              s.proof || u.before || u.behind AS proof,
              CASE WHEN s.n > 1 THEN sha256(u.before || s.cur || u.behind) ELSE s.cur END AS cur)
            FROM {name}_s{i} s JOIN {name}_t{i} t ON s.g IS NOT DISTINCT FROM t.g AND s.r // 3 = t.q,
            LATERAL (SELECT array_to_string(t.ds[1:cast(s.r % 3 AS bigint)], '') AS before,
              array_to_string(t.ds[cast(s.r % 3 + 2 AS bigint):], '') AS behind) u)""")
    return ",\n".join(out)


_MERKLE = f"""WITH leaves AS MATERIALIZED (SELECT doc_id, source AS g, {_leaf('text')} AS leaf,
    CASE WHEN {_ID_SUM} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS cur,
    cast('' AS varchar) AS proof FROM documents),
  placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY g) AS n FROM leaves),
  {_climb('a', 'SELECT g, r, leaf AS d, n FROM placed', 'SELECT * FROM placed')},
  subs AS MATERIALIZED (SELECT g AS source, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place,
    count(*) OVER () AS n FROM a_n{_UP}),
  {_climb('b', 'SELECT 0 AS g, place AS r, d, n FROM subs',
          f'''SELECT s.* REPLACE (0 AS g, p.place AS r, p.n AS n), p.d AS subroot FROM a_s{_UP} s
            JOIN subs p ON s.g IS NOT DISTINCT FROM p.source''')}
  SELECT s.doc_id, s.leaf, s.subroot, r.d AS root, sha256(s.proof) AS proof_sha256, s.cur AS folded_root,
    s.cur = r.d AS verified FROM b_s{_UP} s, b_n{_UP} r"""

# --- repeated windows --------------------------------------------------------------------------

_SUBSTRINGS = f"""WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS ws FROM documents),
  windows AS MATERIALIZED (SELECT k, doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
    FROM (SELECT k, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50)),
  firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
  gone AS (SELECT DISTINCT k, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (h) WHERE first < doc_id),
  left_ AS (SELECT t.k, string_agg(t.w, ' ' ORDER BY t.i) AS kept, count(*) AS n
    FROM (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts) t
    ANTI JOIN gone USING (k, i) GROUP BY t.k)
  SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(len(ws) - coalesce(n, 0) AS bigint) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256 FROM texts LEFT JOIN left_ USING (k)"""

# --- periodic runs -----------------------------------------------------------------------------

_RUNS = f"""WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS ws,
    coalesce({_ID_SUM}, 1) AS h FROM documents),
  rules AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, (h // 10) % 8 AS e FROM texts),
  placed AS (SELECT k, n, ws, h, a, 1 + (n - a) // (3 + e) AS p, unnest(range(0, n)) AS i FROM rules),
  w AS MATERIALIZED (SELECT k, n, i,
    ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM placed),
  pairs AS (SELECT x.k, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.k = y.k AND x.w = y.w AND y.i > x.i
    AND y.i - x.i <= x.n // 3),
  islands AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs),
  found AS MATERIALIZED (SELECT k, q, min(i) AS s, count(*) + q AS len FROM islands GROUP BY k, q, island
    HAVING count(*) + q >= greatest(24, 3 * q)),
  runs AS MATERIALIZED (SELECT * FROM found x WHERE NOT EXISTS (SELECT 1 FROM found y WHERE y.k = x.k AND y.q < x.q
    AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
  best AS (SELECT DISTINCT ON (x.k) x.* FROM runs x
    ORDER BY x.k, x.len // x.q DESC, (x.len % x.q) / x.q DESC, x.s, x.q),
  all_runs AS (SELECT k, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS runs
    FROM runs GROUP BY k),
  left_ AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS kept FROM w WHERE NOT EXISTS (SELECT 1 FROM runs
    WHERE runs.k = w.k AND w.i >= runs.s + runs.q AND w.i < runs.s + runs.len) GROUP BY k)
  SELECT doc_id, coalesce(n_runs, 0) AS n_runs, cast(s AS bigint) AS start, cast(len AS bigint) AS length,
    cast(q AS bigint) AS period, cast(1000 * len // q AS bigint) AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
  FROM texts LEFT JOIN best USING (k) LEFT JOIN all_runs USING (k) LEFT JOIN left_ USING (k)"""

# --- near duplicates ---------------------------------------------------------------------------

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR = rf"""WITH RECURSIVE texts AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
  shingles AS MATERIALIZED (SELECT DISTINCT doc_id, hash(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS s FROM texts)),
  sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
      FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL)
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
  edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach (doc_id, least) AS (SELECT a, a FROM edges UNION SELECT b, least FROM reach JOIN edges ON reach.doc_id = a),
  least AS (SELECT doc_id, min(least) AS least FROM reach GROUP BY doc_id)
  SELECT doc_id, cast(coalesce(n, 0) AS bigint) AS n_shingles, coalesce(least, doc_id) AS component_id,
    coalesce(least, doc_id) = doc_id AS kept FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

ORACLES = {
    "op2_minmax_dedup": _NEAR,
    "op11_merkle_manifest": _MERKLE,
    "op12_substring_dedup": _SUBSTRINGS,
    "op13_periodic_runs": _RUNS,
}
