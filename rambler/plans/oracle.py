"""Oracle SQL (DuckDB dialect) for the query catalogue, written independently of the Spark code.

The derived inputs are spelled out once as CTE text and shared; the walks are
recursive CTEs that reproduce the keyed draws (md5 → 52-bit fraction).
"""

from __future__ import annotations

import re

from rambler.plans.queries import (BLOCK, BUSY_PRICE, EARLIER_END, END, IN_RANGE, L, OUT_RANGE, P, PARTS, Q, REGIONS, SEED, START,
                                   STITCHED_L, LARGE, TINY, TOPN_KEY, TOPN_N, USER_DATE)


def draw_sql(*parts: str) -> str:
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST('0x' || left(md5(concat_ws('|', {inner})), 13) AS BIGINT) / 4503599627370496.0)"


PHONE_RE = "'^(|0*86)(1[34578][0-9]{9})$'"


def norm_sql(c: str) -> str:
    return f"regexp_extract({c}, {PHONE_RE}, 2)"


EVENTS = """pr AS (SELECT a, b FROM (SELECT user_id AS a, lead(user_id) OVER (PARTITION BY event_type, CAST(ts AS DATE)
        ORDER BY ts, event_id) AS b FROM events) s WHERE b IS NOT NULL AND a <> b),
ec AS (SELECT least(a, b) AS src, greatest(a, b) AS dst, CAST(count(*) AS DOUBLE) AS w FROM pr GROUP BY 1, 2)"""

CONTACTS = f"""contacts AS (SELECT o.o_custkey AS user_id,
        (CASE l.l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN '86' WHEN 2 THEN '086' ELSE '12' END) || '139'
        || lpad(CAST(l.l_partkey % (SELECT count(*) FROM customer) AS VARCHAR), 8, '0') AS phone_number,
        CAST(o.o_orderdate AS DATE) AS dt
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
users AS (SELECT c.c_custkey AS id, '139' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS mobile_number,
        concat_ws(',', CAST(c.c_nationkey AS VARCHAR), CAST(n.n_regionkey AS VARCHAR)) AS region_ids,
        DATE '{USER_DATE}' AS dt
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
cin AS (SELECT * FROM contacts WHERE dt BETWEEN DATE '{START}' AND DATE '{END}'),
cn AS (SELECT DISTINCT {norm_sql('phone_number')} AS phone_number, user_id FROM cin
       WHERE {norm_sql('phone_number')} <> ''),
un AS (SELECT {norm_sql('mobile_number')} AS mobile_number, id FROM users
       WHERE dt = DATE '{USER_DATE}' AND mobile_number IS NOT NULL AND {norm_sql('mobile_number')} <> ''),
pairs AS (SELECT un.mobile_number AS src_number, cn.phone_number AS dest_number FROM cn JOIN un ON cn.user_id = un.id
          WHERE un.mobile_number <> cn.phone_number),
outd AS (SELECT src_number AS phone_number, count(*) AS out_degree FROM pairs GROUP BY 1
         HAVING count(*) >= {OUT_RANGE[0]} AND count(*) < {OUT_RANGE[1]}),
ind AS (SELECT dest_number AS phone_number, count(*) AS in_degree FROM pairs GROUP BY 1
        HAVING count(*) >= {IN_RANGE[0]} AND count(*) < {IN_RANGE[1]}),
vin AS (SELECT ind.phone_number FROM ind JOIN outd ON ind.phone_number = outd.phone_number),
pir AS (SELECT * FROM pairs WHERE src_number IN (SELECT phone_number FROM vin)
        AND dest_number IN (SELECT phone_number FROM vin)),
ids AS (SELECT phone_number, row_number() OVER (ORDER BY phone_number) - 1 AS id FROM vin),
ipairs AS (SELECT s.id AS src_number_id, t.id AS dest_number_id FROM pairs
           JOIN ids s ON pairs.src_number = s.phone_number JOIN ids t ON pairs.dest_number = t.phone_number),
cg AS (SELECT src_number_id AS src, dest_number_id AS dst, 1.0::DOUBLE AS w FROM ipairs)"""

PRICES = """pg AS (SELECT l_suppkey AS src, l_partkey + 10000000 AS dst,
        (CAST(round(l_extendedprice * 100) AS BIGINT) % 9973 + 1) / 100.0 AS w FROM lineitem)"""

EMB = """vec AS (SELECT CAST(vec_id AS VARCHAR) AS key, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings),
ep AS (SELECT a.vec_id AS id1, b.vec_id AS id2, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def dot_sql(x: str, y: str) -> str:
    return f"list_reduce(list_transform(range(1, len({x}) + 1), lambda i: {x}[i] * {y}[i]), lambda acc, v: acc + v)"


def norm2_sql(x: str) -> str:
    return f"sqrt(list_reduce(list_transform({x}, lambda a: a * a), lambda acc, v: acc + v))"


def cos_sql(x: str, y: str) -> str:
    den = f"({norm2_sql(x)} * {norm2_sql(y)})"
    return f"(CASE WHEN {den} = 0 THEN CAST('NaN' AS DOUBLE) ELSE {dot_sql(x, y)} / {den} END)"


def oriented(src_cte: str, directed: bool) -> str:
    if directed:
        return f"SELECT src, dst, w FROM {src_cte}"
    return f"SELECT src, dst, w FROM {src_cte} UNION ALL SELECT dst AS src, src AS dst, w FROM {src_cte}"


# Whole units in a weight of 1, where a graph's weights ask for others than 1e8: at least six digits of the least
# weight, unless sums would leave 62 bits.
UNITS = """un AS (SELECT pow(10.0, least(greatest(8, 6 + ceil(-log10((SELECT min(w) FROM {src} WHERE w > 0)))),
      floor(log10(pow(2.0, 62) / (SELECT max(s) FROM (SELECT sum(w) AS s FROM (SELECT src, w FROM {src} UNION ALL SELECT dst, w FROM {src}) o GROUP BY src) x))))) AS u),
"""


def _graph_ctes(src_cte: str, directed: bool, own_units: bool = False) -> str:
    # weights are summed as whole units, of 1e-8 mostly
    u = "(SELECT u FROM un)" if own_units else "100000000.0"
    return (UNITS.replace("{src}", src_cte) if own_units else "") + f"""gu AS (SELECT src, dst, CAST(sum(CAST(round(w * {u}) AS BIGINT)) AS BIGINT) AS wu
      FROM ({oriented(src_cte, directed)}) o GROUP BY src, dst),
g AS (SELECT src, dst, wu / {u} AS w FROM gu),
cum AS (SELECT src, dst, (s - wu) / {u} AS cb, s / {u} AS ca
      FROM (SELECT *, CAST(sum(wu) OVER (PARTITION BY src ORDER BY dst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS s
            FROM gu) u),
st AS (SELECT src, count(*) AS n, max(ca) AS tot, min(dst) AS fd FROM cum GROUP BY src),
vx AS (SELECT vv.v, coalesce(st.n, 0) AS n, coalesce(st.tot, 0.0) AS tot
       FROM (SELECT src AS v FROM g UNION SELECT dst AS v FROM g) vv LEFT JOIN st ON st.src = vv.v),
lst AS (SELECT c.src, c.dst, c.cb, c.ca, c.dst = st.fd AS first, vd.n AS nd, vd.tot AS nt
       FROM cum c JOIN st ON st.src = c.src JOIN vx vd ON vd.v = c.dst),
rr AS (SELECT CAST(unnest(range(0, {{rounds}})) AS INTEGER) AS rnd)"""


def walk_steps_sql(src_cte: str, directed: bool, rounds: int, walk_length: int = L, sampler: str = "rejection",
                   trials: int = 8, p: float = P, q: float = Q, seed: int = SEED, own_units: bool = False) -> tuple[str, str]:
    """(CTE list, name of the steps CTE ``(rnd, v0, step, vertex)``)."""
    graph = _graph_ctes(src_cte, directed, own_units).replace("{rounds}", str(rounds))
    fb, fi, fo = 1.0 / p, 1.0, 1.0 / q
    m = max(fb, fi, fo)
    rb, ri, ro = fb / m, fi / m, fo / m
    if sampler == "rejection":
        u1 = draw_sql(str(seed), "x.rnd", "x.v0", "x.step + 1", "x.t", "1")
        u2 = draw_sql(str(seed), "y.rnd", "y.v0", "y.step + 1", "y.t", "2")
        walk = f"""walk(rnd, v0, step, prev, cur, n, tot, tb) AS (
  SELECT rr.rnd, vx.v, 0, CAST(NULL AS BIGINT), vx.v, vx.n, vx.tot, CAST(0 AS BIGINT) FROM vx CROSS JOIN rr
  UNION ALL
  SELECT rnd, v0, CASE WHEN adv THEN step + 1 ELSE step END, CASE WHEN adv THEN cur ELSE prev END,
         CASE WHEN adv THEN pdst ELSE cur END, CASE WHEN adv THEN pnd ELSE n END,
         CASE WHEN adv THEN pnt ELSE tot END, CASE WHEN adv THEN CAST(0 AS BIGINT) ELSE tb + {trials} END
  FROM (
    SELECT z.rnd, z.v0, z.step, z.prev, z.cur, z.n, z.tot, z.tb, bool_or(z.acc) AS adv,
           arg_min(z.dst, z.t) FILTER (WHERE z.acc) AS pdst, arg_min(z.nd, z.t) FILTER (WHERE z.acc) AS pnd,
           arg_min(z.nt, z.t) FILTER (WHERE z.acc) AS pnt
    FROM (
      SELECT y.*, (y.prev IS NULL OR {u2} < (CASE WHEN y.dst = y.prev THEN {rb!r} WHEN k.src IS NOT NULL THEN {ri!r}
                                              ELSE {ro!r} END)) AS acc
      FROM (
        SELECT x.*, i.dst, i.nd, i.nt FROM (
            SELECT x.*, {u1} * x.tot AS tt FROM (
              SELECT wk.rnd, wk.v0, wk.step, wk.prev, wk.cur, wk.n, wk.tot, wk.tb, wk.tb + tr.i AS t
              FROM walk wk CROSS JOIN (SELECT unnest(range(0, {trials})) AS i) tr
              WHERE wk.n > 0 AND wk.step <= {walk_length}) x) x
        JOIN lst i ON i.src = x.cur
        WHERE i.ca >= x.tt AND (i.cb < x.tt OR i.first)) y
      LEFT JOIN g k ON k.src = y.prev AND k.dst = y.dst) z
    GROUP BY z.rnd, z.v0, z.step, z.prev, z.cur, z.n, z.tot, z.tb) s),
steps AS (SELECT rnd, v0, step, cur AS vertex FROM walk WHERE tb = 0)"""
    else:
        u = draw_sql(str(seed), "wk.rnd", "wk.v0", "wk.step + 1", "0", "1")
        walk = f"""walk(rnd, v0, step, prev, cur) AS (
  SELECT rr.rnd, vx.v, 0, CAST(NULL AS BIGINT), vx.v FROM vx CROSS JOIN rr
  UNION ALL
  SELECT rnd, v0, step + 1, cur, nxt FROM (
    SELECT k.rnd, k.v0, k.step, k.cur,
           coalesce(min(CASE WHEN k.acc >= k.u * k.tot THEN k.dst END), min(k.dst)) AS nxt
    FROM (SELECT c.*, sum(c.wm) OVER (PARTITION BY c.rnd, c.v0 ORDER BY c.dst
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
                 sum(c.wm) OVER (PARTITION BY c.rnd, c.v0) AS tot
          FROM (SELECT wk.rnd, wk.v0, wk.step, wk.cur, e.dst,
                       CASE WHEN wk.prev IS NULL THEN e.w WHEN e.dst = wk.prev THEN e.w / CAST({p!r} AS DOUBLE)
                            WHEN pe.src IS NOT NULL THEN e.w ELSE e.w / CAST({q!r} AS DOUBLE) END AS wm,
                       {u} AS u
                FROM walk wk JOIN g e ON e.src = wk.cur
                LEFT JOIN g pe ON pe.src = wk.prev AND pe.dst = e.dst
                WHERE wk.step <= {walk_length}) c) k
    GROUP BY k.rnd, k.v0, k.step, k.cur) s),
steps AS (SELECT rnd, v0, step, cur AS vertex FROM walk)"""
    return graph + ",\n" + walk, "steps"


def stitched_steps_sql(src_cte: str, rounds: int, walk_length: int, seed: int = SEED) -> tuple[str, str]:
    """The same for walks stitched from segments (undirected): one CTE a doubling, and one a turn of the walkers."""
    moves = walk_length + 1
    top = moves.bit_length() - 1
    ample = lambda m: f"CAST(ceil({m} + 2.0 * sqrt({m}) + 1.0) AS BIGINT)"
    out = [_graph_ctes(src_cte, False).replace("{rounds}", str(rounds)),
           "sh AS (SELECT v, coalesce(win, 0)::DOUBLE / (SELECT sum(wu) FROM gu)::DOUBLE AS share FROM vx LEFT JOIN (SELECT dst AS v, sum(wu) AS win FROM gu GROUP BY 1) i USING (v) WHERE n > 0)",
           f"c{top} AS MATERIALIZED (SELECT v, share, CAST({rounds} AS BIGINT) AS n, 0 AS h, 0 AS t FROM sh)"]
    for i in range(top - 1, -1, -1):
        want = "1.0" if moves >> i & 1 else "0.15"
        tails, own = ample(f"(share * (SELECT sum(n) FROM c{i + 1})::DOUBLE)"), ample(f"(share * ({want} * (SELECT count(*) * {rounds} FROM sh)))")
        out.append(f"c{i} AS MATERIALIZED (SELECT v, share, n + {tails} + {own} AS n, n AS h, {tails} AS t FROM c{i + 1})")
    u = draw_sql(str(seed), "'segment'", "v", "j")
    out.append(f"""s0 AS MATERIALIZED (SELECT x.v, x.j, [i.dst] AS path, i.dst AS e, i.nd AS en
  FROM (SELECT v, j, {u} * tot AS tt FROM (SELECT c0.v, vx.tot, unnest(range(0, c0.n)) AS j FROM c0 JOIN vx USING (v)) y) x JOIN lst i ON i.src = x.v
  WHERE i.ca >= x.tt AND (i.cb < x.tt OR i.first))""")
    for i in range(top):
        out.append(f"""s{i + 1} AS MATERIALIZED (SELECT a.v, a.j, CASE WHEN b.v IS NULL THEN a.path ELSE list_concat(a.path, b.path) END AS path,
  coalesce(b.e, a.e) AS e, coalesce(b.en, a.en) AS en
  FROM (SELECT s.*, row_number() OVER (PARTITION BY e, en > 0 ORDER BY v, j) - 1 AS k FROM s{i} s JOIN c{i} USING (v) WHERE j < h) a
  LEFT JOIN (SELECT s.*, j - h AS k FROM s{i} s JOIN c{i} USING (v) WHERE j >= h AND j < h + t) b ON a.en > 0 AND b.v = a.e AND b.k = a.k)""")
    pool = " UNION ALL ".join(f"SELECT {i} AS level, v, j - h - t AS k, path, e, en FROM s{i} JOIN c{i} USING (v) WHERE j >= h + t" for i in range(top + 1))
    out += [f"pool AS MATERIALIZED ({pool})", "w0 AS (SELECT rr.rnd, vx.v AS v0, 0 AS step, vx.v AS cur, vx.n FROM vx CROSS JOIN rr)"]
    own = draw_sql(str(seed), "a.rnd", "a.v0", "a.step + 1", "0", "1")
    for t in range(1, moves + 1):
        before = " UNION ALL ".join(["SELECT 0 AS level, 0 AS cur WHERE false", *[f"SELECT level, cur FROM q{x}" for x in range(1, t)]])
        out.append(f"q{t} AS MATERIALIZED (SELECT *, CAST(floor(log2({moves} - step + 0.5)) AS INTEGER) AS level FROM w{t - 1} WHERE n > 0 AND step < {moves})")
        out.append(f"""m{t} AS MATERIALIZED (SELECT a.rnd, a.v0, a.step, coalesce(p.path, [i.dst]) AS path, coalesce(p.e, i.dst) AS e, coalesce(p.en, i.nd) AS en
  FROM (SELECT q.*, {own.replace('a.', 'q.')} * vx.tot AS tt, row_number() OVER (PARTITION BY q.level, q.cur ORDER BY rnd, v0) - 1 + coalesce(used, 0) AS k
        FROM q{t} q JOIN vx ON vx.v = q.cur LEFT JOIN (SELECT level, cur, count(*) AS used FROM ({before}) y GROUP BY 1, 2) z ON z.level = q.level AND z.cur = q.cur) a
  LEFT JOIN pool p ON p.level = a.level AND p.v = a.cur AND p.k = a.k
  LEFT JOIN lst i ON p.v IS NULL AND i.src = a.cur AND i.ca >= a.tt AND (i.cb < a.tt OR i.first))""")
        out.append(f"w{t} AS (SELECT rnd, v0, step + len(path) AS step, e AS cur, en AS n FROM m{t})")
    moved = " UNION ALL ".join(f"SELECT rnd, v0, step + generate_subscripts(path, 1) AS step, unnest(path) AS vertex FROM m{t}" for t in range(1, moves + 1))
    out.append(f"steps AS (SELECT rnd, v0, step, cur AS vertex FROM w0 UNION ALL {moved})")
    return ",\n".join(out), "steps"


def walk_paths_sql(src_cte: str, directed: bool, rounds: int, base: str, **kw) -> tuple[str, str]:
    ctes, steps = stitched_steps_sql(src_cte, rounds, kw["walk_length"]) if kw.get("sampler") == "stitched" else walk_steps_sql(src_cte, directed, rounds, **kw)
    paths = f"""wp AS (SELECT CAST(rnd AS INTEGER) AS rnd, v0, string_agg(CAST(vertex AS VARCHAR), ' ' ORDER BY step) AS path,
               CAST(count(*) AS BIGINT) AS len FROM {steps} GROUP BY rnd, v0)"""
    return f"WITH RECURSIVE {base},\n{ctes},\n{paths}\n", "wp"


def _w(src_cte, directed, rounds, base, final, **kw):
    head, wp = walk_paths_sql(src_cte, directed, rounds, base, **kw)
    return head + final.replace("{wp}", wp)


E = f"WITH {EVENTS}\n"
CT = f"WITH {CONTACTS}\n"
EM = f"WITH {EMB}\n"
FIRST_DRAW = draw_sql(str(SEED), "0", "c.src", "1", "0", "1")

ORACLE = {
    "contacts_in_range": f"WITH {CONTACTS} SELECT user_id, phone_number, dt FROM cin",
    "users_snapshot": f"WITH {CONTACTS} SELECT id, mobile_number, region_ids FROM users "
                      f"WHERE dt = DATE '{USER_DATE}' AND mobile_number IS NOT NULL",
    "edge_list_scan": E + """, ln AS (SELECT concat_ws(' ', CAST(src AS VARCHAR), CAST(dst AS VARCHAR),
            CASE WHEN w > 3 THEN 'x' ELSE CAST(CAST(w AS BIGINT) AS VARCHAR) END) AS value FROM ec),
        sp AS (SELECT string_split(trim(value), ' ') AS p FROM ln)
        SELECT TRY_CAST(p[1] AS BIGINT) AS src, TRY_CAST(p[2] AS BIGINT) AS dst,
               coalesce(CASE WHEN len(p) >= 3 THEN TRY_CAST(p[len(p)] AS DOUBLE) END, 1.0) AS w FROM sp""",
    "walk_series_scan": _w("ec", False, 1, EVENTS, """SELECT array_to_string(string_split(path, ' '), ',') AS tokens,
        CAST(len(string_split(path, ' ')) AS BIGINT) AS n FROM {wp}"""),
    "vector_text_scan": f"""WITH {EMB}, ln AS (SELECT key || ' ' || array_to_string(vector, ' ') AS value FROM vec),
        sp AS (SELECT string_split(value, ' ') AS p FROM ln),
        pv AS (SELECT p[1] AS number, list_transform(p[2:], lambda s: CAST(s AS DOUBLE)) AS v FROM sp)
        SELECT number, CAST(generate_subscripts(v, 1) - 1 AS BIGINT) AS i, unnest(v) AS x FROM pv""",
    "paths_as_lines": _w("ec", False, 1, EVENTS, "SELECT rnd, v0, replace(path, ' ', chr(9)) AS line FROM {wp}"),
    "phone_normalize": f"WITH {CONTACTS} SELECT user_id, phone_number, {norm_sql('phone_number')} AS normalized FROM contacts",
    "users_in_regions": f"WITH {CONTACTS} SELECT id, mobile_number, region_ids FROM users WHERE "
                        + " OR ".join(f"region_ids LIKE '%{r}%'" for r in REGIONS),
    "path_tokens": _w("ec", False, 1, EVENTS, "SELECT path AS tokens FROM {wp}"),
    "vector_dot": f"WITH {EMB} SELECT id1, id2, round({dot_sql('x', 'y')}, 6) AS dot FROM ep",
    "vector_norm": f"SELECT vec_id, round({norm2_sql('CAST(embedding AS DOUBLE[])')}, 6) AS norm FROM embeddings",
    "cosine_pairs": f"WITH {EMB} SELECT id1, id2, round({cos_sql('x', 'y')}, 6) AS cos FROM ep",
    "phone_pairs": CT + "SELECT src_number, dest_number FROM pairs",
    "distinct_contacts": CT + "SELECT phone_number, user_id FROM cn",
    "out_degree_in_range": CT + "SELECT phone_number, out_degree FROM outd",
    "in_degree_in_range": CT + "SELECT phone_number, in_degree FROM ind",
    "out_degree_histogram": CT + "SELECT out_degree, count(*) AS total_num FROM outd GROUP BY out_degree",
    "in_degree_histogram": CT + "SELECT in_degree, count(*) AS total_num FROM ind GROUP BY in_degree",
    "vertices_in_degree_range": CT + "SELECT phone_number FROM vin",
    "pairs_in_degree_range": CT + "SELECT src_number, dest_number FROM pir",
    "dense_ids": CT + "SELECT phone_number, CAST(id AS BIGINT) AS id FROM ids",
    "indexed_pairs": CT + "SELECT src_number_id, dest_number_id FROM ipairs",
    "graph_counts": CT + "SELECT (SELECT count(*) FROM ids) AS node_count, (SELECT count(*) FROM pir) AS edge_count",
    "named_vectors": f"WITH {CONTACTS}, {EMB} SELECT ids.phone_number, ids.id, CAST(len(vec.vector) AS BIGINT) AS dim "
                     "FROM vec JOIN ids ON CAST(vec.key AS BIGINT) = ids.id",
    "edges_undirected": CT + "SELECT src, dst, w FROM cg UNION ALL SELECT dst AS src, src AS dst, w FROM cg",
    "graph_vertices": CT + "SELECT DISTINCT v FROM (SELECT src AS v FROM cg UNION ALL SELECT dst AS v FROM cg) x",
    "adjacency": CT + """, o AS (SELECT src, dst, w FROM cg UNION ALL SELECT dst AS src, src AS dst, w FROM cg),
        ob AS (SELECT src, dst, w, CAST(floor((row_number() OVER (PARTITION BY src ORDER BY dst, w) - 1) / 1024) AS BIGINT) AS block FROM o)
        SELECT src, block, CAST(count(*) AS BIGINT) AS n,
               string_agg(CAST(dst AS VARCHAR) || ':' || CAST(CAST(w AS BIGINT) AS VARCHAR), ' ' ORDER BY dst, w) AS nbrs
        FROM ob GROUP BY src, block""",
    "adjacency_directed": E + f""", ob AS (SELECT src, dst, w,
               CAST(floor((row_number() OVER (PARTITION BY src ORDER BY dst) - 1) / {BLOCK}) AS BIGINT) AS block FROM ec)
        SELECT src, block, CAST(count(*) AS BIGINT) AS n,
               string_agg(CAST(dst AS VARCHAR) || ':' || CAST(CAST(w AS BIGINT) AS VARCHAR), ' ' ORDER BY dst) AS nbrs
        FROM ob GROUP BY src, block
        UNION ALL SELECT DISTINCT dst, CAST(0 AS BIGINT), CAST(0 AS BIGINT), '' FROM ec WHERE dst NOT IN (SELECT src FROM ec)""",
    "graph_stats": E + """, o AS (SELECT src, dst FROM ec UNION ALL SELECT dst, src FROM ec)
        SELECT (SELECT count(*) FROM (SELECT src AS v FROM o UNION SELECT dst FROM o) v) AS vertices,
               (SELECT count(*) FROM o) AS entries""",
    "neighbors_of": E + """, vv AS (SELECT src AS v FROM ec UNION SELECT dst FROM ec)
        SELECT vv.v, ec.dst, ec.w FROM vv LEFT JOIN ec ON ec.src = vv.v""",
    "weighted_sample": E + f""", g AS (SELECT src, dst, sum(w) AS w FROM ({oriented('ec', False)}) o GROUP BY src, dst),
        c AS (SELECT src, dst, w, {FIRST_DRAW} AS u,
                     sum(w) OVER (PARTITION BY src ORDER BY dst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
                     sum(w) OVER (PARTITION BY src) AS tot FROM g c)
        SELECT src AS v0, coalesce(min(CASE WHEN acc >= u * tot THEN dst END), min(dst)) AS next FROM c GROUP BY src""",
    "walkers_init": E + """, vv AS (SELECT src AS v FROM ec UNION SELECT dst FROM ec)
        SELECT r.rnd, vv.v AS v0 FROM vv CROSS JOIN (SELECT CAST(unnest([0, 1]) AS INTEGER) AS rnd) r""",
    "first_step": _w("ec", True, 2, EVENTS, "SELECT * FROM {wp}", walk_length=0),
    "random_walk_undirected": _w("cg", False, 1, CONTACTS, "SELECT * FROM {wp}"),
    "random_walk_weighted": _w("ec", False, 1, EVENTS, "SELECT * FROM {wp}"),
    "random_walk_directed": _w("ec", True, 2, EVENTS, "SELECT * FROM {wp}"),
    "random_walk_cdf": _w("ec", False, 1, EVENTS, "SELECT * FROM {wp}", sampler="cdf"),
    # no bucket index here: every trial scans the whole list of its vertex
    "random_walk_decimal": _w("pg", False, 1, PRICES, "SELECT * FROM {wp}"),
    # many edges are lighter than 1e-8, or heavier than 64 bits hold units of 1e-8
    "random_walk_tiny_weights": _w("et", False, 1, EVENTS + f", et AS (SELECT src, dst, w * {TINY!r} AS w FROM ec)", "SELECT * FROM {wp}", own_units=True),
    "random_walk_large_weights": _w("el", False, 1, EVENTS + f", el AS (SELECT src, dst, w * {LARGE!r} AS w FROM ec)", "SELECT * FROM {wp}", own_units=True),
    "random_walk_resumed": _w("ec", False, 1, EVENTS, "SELECT * FROM {wp}"),
    "random_walk_stitched": _w("ec", False, 2, EVENTS, "SELECT * FROM {wp}", sampler="stitched", walk_length=STITCHED_L),
    "dead_end_walks": _w("ec", True, 2, EVENTS, f"SELECT rnd, v0, len FROM {{wp}} WHERE len < {L + 2}"),
    "walk_counts": _w("ec", True, 2, EVENTS, "SELECT rnd, count(*) AS paths FROM {wp} GROUP BY rnd"),
    # Word2Vec's vocabulary with minCount = 0 is every vertex on a path; one vector of dim 16 each
    "node_embedding_size": _w("ec", False, 1, EVENTS, """SELECT DISTINCT CAST(vertex AS VARCHAR) AS key,
        CAST(16 AS BIGINT) AS dim FROM steps"""),
    # trained by buckets: a vector for every vertex, and walks' neighbours are closer than other pairs
    "node_embedding_buckets": _w("ec", False, 1, EVENTS, """SELECT count(DISTINCT vertex) AS words, CAST(16 AS BIGINT) AS dim, count(DISTINCT vertex) AS finite,
        true AS neighbours_closer FROM steps"""),
    "walk_quality": _w("ec", True, 2, EVENTS, f"""SELECT (SELECT count(*) FROM {{wp}}) AS paths,
        (SELECT count(*) * 2 FROM (SELECT src AS v FROM ec UNION SELECT dst FROM ec) vv) AS expected_paths,
        (SELECT CAST(sum(CASE WHEN len < {L + 2} THEN 1 ELSE 0 END) AS BIGINT) FROM {{wp}}) AS short_paths,
        (SELECT count(*) FROM steps a JOIN steps b ON a.rnd = b.rnd AND a.v0 = b.v0 AND b.step = a.step + 1
         WHERE NOT EXISTS (SELECT 1 FROM ec WHERE ec.src = a.vertex AND ec.dst = b.vertex)) AS invalid_steps"""),
    "vector_lookup": f"""WITH {EMB}, ks AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS key FROM customer),
        f AS (SELECT vec.key, vec.vector FROM vec JOIN ks ON vec.key = ks.key)
        SELECT key, CAST(generate_subscripts(vector, 1) - 1 AS BIGINT) AS i, unnest(vector) AS x FROM f""",
    "vector_lookup_missing": f"""WITH {EMB} SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS key FROM customer
        WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT key FROM vec)""",
    "pair_similarity": f"""WITH {EMB}, pp AS (SELECT CAST(vec_id AS VARCHAR) AS k1, CAST(vec_id + 2 AS VARCHAR) AS k2 FROM embeddings)
        SELECT pp.k1, pp.k2, round({cos_sql('a.vector', 'b.vector')}, 6) AS cos
        FROM pp JOIN vec a ON a.key = pp.k1 JOIN vec b ON b.key = pp.k2""",
    "topn_similar": f"""WITH {EMB}, qv AS (SELECT vector AS qx FROM vec WHERE key = '{TOPN_KEY}')
        SELECT key, round({cos_sql('qv.qx', 'vec.vector')}, 6) AS cos FROM vec, qv
        ORDER BY cos DESC, key LIMIT {TOPN_N + 1}""",
    "topn_similar_batch": f"""WITH {EMB}, c AS (SELECT a.key AS query, b.key, round({cos_sql('a.vector', 'b.vector')}, 6) AS cos
            FROM (SELECT * FROM vec WHERE key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)) a, vec b)
        SELECT query, CAST(rank AS INTEGER) AS rank, key, cos
        FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cos DESC, key) AS rank FROM c) r WHERE rank <= {TOPN_N + 1}""",
}

# Parts of the vertex-cut operators.
_PART = draw_sql(str(SEED), "'part'", "least(src, dst)", "greatest(src, dst)")
_PARTED = E + f""", pe AS (SELECT src, dst, w, CAST(floor({_PART} * {PARTS}) AS INTEGER) AS part FROM ec),
    po AS (SELECT src, dst, w, part FROM pe UNION ALL SELECT dst AS src, src AS dst, w, part FROM pe)\n"""
ORACLE.update({
    "edge_partitions": _PARTED + "SELECT src, dst, part FROM po",
    "vertex_home_partition": _PARTED + "SELECT src AS v, min(part) AS part FROM po GROUP BY src",
    "partition_balance": _PARTED + "SELECT part, count(DISTINCT src) AS replicas, count(*) AS links FROM po GROUP BY part",
    "replication_factor": _PARTED + """, r AS (SELECT count(*) AS replicas FROM (SELECT DISTINCT src, part FROM po) x),
        v AS (SELECT count(DISTINCT src) AS vertices FROM po)
        SELECT r.replicas, v.vertices, round(r.replicas / v.vertices, 6) AS factor FROM r, v""",
    "vertex_replicas": _PARTED + """, vp AS (SELECT DISTINCT src AS v, part FROM po)
        SELECT vp.part, vp.v, po.dst, po.w FROM vp JOIN po ON po.src = vp.v""",
    "edge_partitions_given": _PARTED + f"""SELECT src, dst, CAST(CASE WHEN (src + dst) % 3 = 0 THEN src % {PARTS} ELSE part END AS INTEGER) AS part
        FROM pe""",
})

# Text forms and jobs: what they write is what the plain walk gives.
_VERTICES = "(SELECT DISTINCT vertex FROM steps)"
ORACLE.update({
    "edge_list_forms": E + f"""SELECT 'plain' AS form, src, dst, 1.0::DOUBLE AS w, CAST(NULL AS INTEGER) AS part FROM ec
        UNION ALL SELECT 'weight', src, dst, w, CAST(NULL AS INTEGER) FROM ec
        UNION ALL SELECT 'part', src, dst, 1.0, CAST(CASE WHEN src % 5 <> 0 THEN src % {PARTS} END AS INTEGER) FROM ec
        UNION ALL SELECT 'part_weight', src, dst, w, CAST(CASE WHEN src % 5 <> 0 THEN src % {PARTS} END AS INTEGER) FROM ec""",
    "edge_line_counts": E + "SELECT 3 * count(*) + 2 AS lines, count(*) AS edges, CAST(1 AS BIGINT) AS blank, 2 * count(*) + 1 AS skipped FROM ec",
    "job_walk": _w("ec", False, 1, EVENTS, "SELECT replace(path, ' ', chr(9)) AS line FROM {wp}"),
    "job_node2vec": _w("ec", False, 1, EVENTS, f"SELECT CAST(vertex AS VARCHAR) AS number, CAST(16 AS BIGINT) AS dim FROM {_VERTICES} v"),
    "job_embedding": _w("cg", False, 1, CONTACTS, f"""SELECT ids.phone_number AS number, CAST(16 AS BIGINT) AS dim
        FROM {_VERTICES} v JOIN ids ON ids.id = v.vertex"""),
    "job_model": _w("ec", False, 1, EVENTS, f"SELECT count(*) AS words, CAST(16 AS BIGINT) AS dim FROM {_VERTICES} v"),
    "output_files": E + """SELECT 'single' AS setting, CAST(1 AS BIGINT) AS files, count(*) AS edges FROM ec
        UNION ALL SELECT 'several', 3, count(*) FROM ec""",
})

# S1 by day, ids over two runs, parts by degree.
_EARLIER = re.sub(r"\b(cin|cn|un|pairs|outd|ind|vin|pir|ids|ipairs|cg)\b", r"\1_1", CONTACTS[CONTACTS.index("cin AS"):].replace(END, EARLIER_END))
_LOW = "CASE WHEN a.n < b.n OR (a.n = b.n AND e.src < e.dst) THEN e.src ELSE e.dst END"
_BY_DEGREE = f"""WITH {PRICES}, e AS (SELECT src, dst FROM pg GROUP BY src, dst),
    dg AS (SELECT v, count(*) AS n FROM (SELECT src AS v FROM e UNION ALL SELECT dst FROM e) x GROUP BY v),
    lo AS (SELECT e.*, {_LOW} AS low FROM e JOIN dg a ON a.v = e.src JOIN dg b ON b.v = e.dst),
    pe AS (SELECT src, dst, CAST(floor({draw_sql(str(SEED), "'part'", 'low')} * {PARTS}) AS INTEGER) AS part, CAST(floor({_PART} * {PARTS}) AS INTEGER) AS drawn FROM lo),
    po AS (SELECT * FROM pe UNION ALL SELECT dst AS src, src AS dst, part, drawn FROM pe)\n"""
ORACLE.update({
    "contacts_by_date": ORACLE["contacts_in_range"],
    "contacts_on_busy_days": f"""WITH {CONTACTS} SELECT user_id, phone_number, dt FROM contacts
        WHERE dt IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > {BUSY_PRICE})""",
    "stable_ids": f"""WITH {CONTACTS}, {_EARLIER}, fresh AS (SELECT phone_number FROM vin WHERE phone_number NOT IN (SELECT phone_number FROM vin_1))
        SELECT phone_number, CAST(id AS BIGINT) AS id FROM ids_1
        UNION ALL SELECT phone_number, CAST((SELECT count(*) FROM ids_1) + row_number() OVER (ORDER BY phone_number) - 1 AS BIGINT) FROM fresh""",
    "edge_partitions_by_degree": _BY_DEGREE + "SELECT src, dst, part FROM po",
    "replication_factor_by_degree": _BY_DEGREE + """, v AS (SELECT count(DISTINCT src) AS n FROM po), r AS (SELECT count(*) AS n FROM (SELECT DISTINCT src, part FROM po) x),
        d AS (SELECT count(*) AS n FROM (SELECT DISTINCT src, drawn FROM po) x)
        SELECT r.n AS replicas, v.n AS vertices, round(r.n / v.n, 6) AS factor, round(d.n / v.n, 6) AS drawn_factor FROM r, v, d""",
    "random_walk_partitioned": _w("ec", False, 1, EVENTS, f"""SELECT rnd, v0, part, path, len FROM {{wp}} JOIN (
        SELECT v, min(part) AS part FROM (SELECT src, dst, CAST(CASE WHEN (src + dst) % 3 = 0 THEN src % {PARTS} ELSE floor({_PART} * {PARTS}) END AS INTEGER) AS part FROM ec) p,
            LATERAL (SELECT unnest([src, dst]) AS v) y GROUP BY v) h ON h.v = v0"""),
})

# Second-order weights and step for the walkers after the first step.
_SECOND = E + f""", g AS (SELECT src, dst, sum(w) AS w FROM ({oriented('ec', False)}) o GROUP BY src, dst),
    c AS (SELECT src, dst, w, {FIRST_DRAW} AS u,
                 sum(w) OVER (PARTITION BY src ORDER BY dst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
                 sum(w) OVER (PARTITION BY src) AS tot FROM g c),
    fs AS (SELECT src AS v0, coalesce(min(CASE WHEN acc >= u * tot THEN dst END), min(dst)) AS cur FROM c GROUP BY src),
    cw AS (SELECT fs.v0, fs.v0 AS prev, fs.cur, e.dst,
                  CASE WHEN e.dst = fs.v0 THEN e.w / CAST({P!r} AS DOUBLE) WHEN k.src IS NOT NULL THEN e.w
                       ELSE e.w / CAST({Q!r} AS DOUBLE) END AS w2
           FROM fs JOIN g e ON e.src = fs.cur LEFT JOIN g k ON k.src = fs.v0 AND k.dst = e.dst)\n"""
_U2 = draw_sql(str(SEED), "0", "v0", "2", "0", "1")
ORACLE.update({
    "second_order_weights": _SECOND + "SELECT v0, dst, w2 FROM cw",
    "second_order_step": _SECOND + f""", cc AS (SELECT v0, dst, {_U2} AS u,
            sum(w2) OVER (PARTITION BY v0 ORDER BY dst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc,
            sum(w2) OVER (PARTITION BY v0) AS tot FROM cw)
        SELECT v0, coalesce(min(CASE WHEN acc >= u * tot THEN dst END), min(dst)) AS next FROM cc GROUP BY v0""",
})
