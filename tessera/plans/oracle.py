"""Plain SQL (DuckDB dialect) that computes what each registered query computes.

The clustering SQL is generated: seeding rounds and Lloyd iterations are
unrolled into materialized CTEs, with the same hash-based draws, tie rules and
stop test as the Spark operators. It is an independent statement of the
semantics, used only to check the Spark results.
"""

from __future__ import annotations

from tessera.plans import catalog as Q

# 2^52 + 1, the span of the hash-based uniform draw.
_SPAN = "4503599627370497.0"
_INF = "'Infinity'::DOUBLE"


def _hash52(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13))::BIGINT"


def _u(seed: int, rnd: int, id_expr: str) -> str:
    return f"(({_hash52(repr(str(seed)), repr(str(rnd)), id_expr)} + 1)::DOUBLE / {_SPAN})"


def _bucket(n: int, seed: int, id_expr: str) -> str:
    return f"({_hash52(repr('part'), repr(str(seed)), id_expr)} % {n})::INTEGER"


def _dist(a: str, b: str) -> str:
    return (
        f"sqrt(list_reduce(list_transform(list_zip({a}, {b}), "
        f"lambda t: (t[1] - t[2]) * (t[1] - t[2])), lambda s, e: s + e))"
    )


def _rvec(v: str, digits: int = Q.VECTOR_DIGITS) -> str:
    return f"list_transform({v}, lambda x: round(x, {digits}))"


def _words(line: str) -> str:
    return (
        f"CASE WHEN {line} = '' THEN [''] "
        f"WHEN rtrim({line}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({line}, ' '), ' ') END"
    )


_LINES = f"""
SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_no, unnest(ls) AS line
FROM (
  SELECT doc_id,
         CASE WHEN text = '' THEN []::VARCHAR[]
              WHEN right(text, 1) IN (chr(10), chr(13)) THEN parts[1:len(parts) - 1]
              ELSE parts END AS ls
  FROM (SELECT doc_id, text, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS parts
        FROM documents WHERE text IS NOT NULL)
)"""

_WORD_COUNT = f"""
SELECT word, count(*) AS n
FROM (SELECT unnest({_words('line')}) AS word FROM ({_LINES}))
GROUP BY word"""


# ---------------------------------------------------------------- clustering


def _points_cte(weight: str = "1.0") -> str:
    return (
        "SELECT 0 AS part, vec_id AS id, embedding::DOUBLE[] AS v, "
        f"({weight})::DOUBLE AS w FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL"
    )


def _seed_ctes(pts: str, k: int, seed: int, p: str) -> tuple[list[str], str]:
    """CTEs for k seeding rounds; the last CTE holds ``part, label, id, v``."""
    ctes = [
        f"""{p}s0 AS MATERIALIZED (
  SELECT part, 0 AS label, id, v FROM (
    SELECT part, id, v, row_number() OVER (PARTITION BY part ORDER BY {_u(seed, 0, 'id')}, id) AS rn
    FROM {pts}) WHERE rn = 1)""",
        f"{p}ch1 AS MATERIALIZED (SELECT * FROM {p}s0)",
    ]
    for r in range(1, k):
        ctes.append(
            f"""{p}d{r} AS MATERIALIZED (
  SELECT q.part, q.id, min({_dist('q.v', 'c.v')}) AS d
  FROM {pts} q JOIN {p}ch{r} c ON q.part = c.part
  WHERE NOT EXISTS (SELECT 1 FROM {p}ch{r} x WHERE x.part = q.part AND x.id = q.id)
  GROUP BY q.part, q.id)"""
        )
        key = f"CASE WHEN q.w * d.d > 0 THEN -ln({_u(seed, r, 'q.id')}) / (q.w * d.d) ELSE {_INF} END"
        ctes.append(
            f"""{p}s{r} AS MATERIALIZED (
  SELECT part, {r} AS label, id, v FROM (
    SELECT q.part, q.id, q.v, row_number() OVER (PARTITION BY q.part ORDER BY {key}, q.id) AS rn
    FROM {pts} q JOIN {p}d{r} d ON q.part = d.part AND q.id = d.id) WHERE rn = 1)"""
        )
        ctes.append(f"{p}ch{r + 1} AS MATERIALIZED (SELECT * FROM {p}ch{r} UNION ALL SELECT * FROM {p}s{r})")
    return ctes, f"{p}ch{k}"


def _assign_cte(name: str, pts: str, centers: str) -> str:
    """``part, id, w, v, label, dist``: nearest center, ties to the lowest label."""
    d = _dist("q.v", "c.center")
    return f"""{name} AS MATERIALIZED (
  SELECT part, id, w, v, label, dist FROM (
    SELECT q.part, q.id, q.w, q.v, c.label, {d} AS dist,
           row_number() OVER (PARTITION BY q.part, q.id ORDER BY {d}, c.label) AS rn
    FROM {pts} q JOIN {centers} c ON q.part = c.part) WHERE rn = 1)"""


def _means_cte(name: str, assigned: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT part, label, list(val ORDER BY j) AS center FROM (
    SELECT part, label, j, sum(w * x) / sum(w) AS val FROM (
      SELECT part, label, w, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM {assigned})
    GROUP BY part, label, j)
  GROUP BY part, label)"""


def _lloyd_ctes(pts: str, init: str, iterations: int, final_pass: bool, p: str) -> tuple[list[str], str, str | None]:
    """Unrolled Lloyd steps with the stop test; returns (ctes, centers, last assignment)."""
    ctes = [
        f"{p}c0 AS MATERIALIZED (SELECT part, label, center FROM {init})",
        f"{p}st0 AS MATERIALIZED (SELECT DISTINCT part, {_INF} AS best, false AS done FROM {p}c0)",
    ]
    last = None
    passes = iterations + (1 if final_pass else 0)
    for t in range(passes):
        ctes.append(_assign_cte(f"{p}a{t}", pts, f"{p}c{t}"))
        last = f"{p}a{t}"
        if t >= 1 and (t - 1) % 8 == 0:
            ctes.append(
                f"""{p}o{t} AS MATERIALIZED (SELECT part, sum(w * dist) / sum(w) AS obj FROM {p}a{t} GROUP BY part)"""
            )
            ctes.append(
                f"""{p}st{t + 1} AS MATERIALIZED (
  SELECT s.part,
         CASE WHEN s.done THEN s.best WHEN o.obj < s.best THEN o.obj ELSE s.best END AS best,
         s.done OR NOT (o.obj < s.best) AS done
  FROM {p}st{t} s JOIN {p}o{t} o ON s.part = o.part)"""
            )
        else:
            ctes.append(f"{p}st{t + 1} AS MATERIALIZED (SELECT * FROM {p}st{t})")
        if t < iterations:
            ctes.append(_means_cte(f"{p}m{t}", f"{p}a{t}"))
            ctes.append(
                f"""{p}c{t + 1} AS MATERIALIZED (
  SELECT c.part, c.label, CASE WHEN s.done OR m.center IS NULL THEN c.center ELSE m.center END AS center
  FROM {p}c{t} c JOIN {p}st{t + 1} s ON c.part = s.part
  LEFT JOIN {p}m{t} m ON c.part = m.part AND c.label = m.label)"""
            )
    final = f"{p}c{iterations}"
    return ctes, final, last


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _seeded(weight: str = "1.0") -> tuple[list[str], str]:
    ctes = [f"pts AS MATERIALIZED ({_points_cte(weight)})"]
    seed_ctes, chosen = _seed_ctes("pts", Q.K, Q.SEED, "k_")
    ctes += seed_ctes
    ctes.append(f"seeds AS MATERIALIZED (SELECT part, label, id, v AS center FROM {chosen})")
    return ctes, "seeds"


def _seed_centers_sql() -> str:
    ctes, seeds = _seeded()
    return _with(ctes, f"SELECT label, id, {_rvec('center')} AS center FROM {seeds}")


def _single_assign(weight: str = "1.0") -> list[str]:
    ctes, seeds = _seeded(weight)
    return ctes + [_assign_cte("a", "pts", seeds)]


def _assign_nearest_sql() -> str:
    return _with(_single_assign(), f"SELECT id, label, round(dist, {Q.VECTOR_DIGITS}) AS dist FROM a")


def _cluster_sizes_sql() -> str:
    body = """SELECT s.label, count(a.id) AS size
FROM seeds s LEFT JOIN a ON s.part = a.part AND s.label = a.label GROUP BY s.label"""
    return _with(_single_assign(), body)


def _weighted_assign() -> list[str]:
    # Seeds are drawn with unit weights (as the registered query does); the
    # assignment then carries the weight label + 1.
    ctes, seeds = _seeded()
    ctes.append(
        "wpts AS MATERIALIZED (SELECT 0 AS part, vec_id AS id, embedding::DOUBLE[] AS v, "
        "(label + 1)::DOUBLE AS w FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)"
    )
    ctes.append(_assign_cte("a", "wpts", seeds))
    return ctes


def _kmedian_cost_sql() -> str:
    return _with(_single_assign(), f"SELECT round(sum(w * dist) / sum(w), {Q.SCALAR_DIGITS}) AS cost FROM a")


def _lloyd_step_sql() -> str:
    ctes = _single_assign() + [_means_cte("m", "a")]
    body = f"""SELECT s.label, {_rvec('coalesce(m.center, s.center)')} AS center
FROM seeds s LEFT JOIN m ON s.part = m.part AND s.label = m.label"""
    return _with(ctes, body)


def _lloyd_sql() -> str:
    ctes, seeds = _seeded()
    lctes, final, _ = _lloyd_ctes("pts", seeds, Q.LLOYD_ITERATIONS, False, "l_")
    return _with(ctes + lctes, f"SELECT label, {_rvec('center')} AS center FROM {final}")


def _kmedian_sql() -> str:
    ctes, seeds = _seeded()
    lctes, final, _ = _lloyd_ctes("pts", seeds, Q.KMEDIAN_ITERATIONS, False, "l_")
    return _with(ctes + lctes, f"SELECT label, {_rvec('center')} AS center FROM {final}")


def _kmedian_weighted_sql() -> str:
    ctes, seeds = _seeded("label + 1")
    lctes, final, _ = _lloyd_ctes("pts", seeds, Q.KMEDIAN_ITERATIONS, False, "l_")
    return _with(ctes + lctes, f"SELECT label, {_rvec('center')} AS center FROM {final}")


def _kmedian_with_cost_sql() -> str:
    ctes, seeds = _seeded()
    lctes, final, _ = _lloyd_ctes("pts", seeds, Q.KMEDIAN_ITERATIONS, False, "l_")
    ctes = ctes + lctes
    ctes.append(
        f"""obj AS MATERIALIZED (
  SELECT sum(w * d) / sum(w) AS cost FROM (
    SELECT q.w, (SELECT min({_dist('q.v', 'c.center')}) FROM {final} c) AS d FROM pts q))"""
    )
    body = f"SELECT c.label, {_rvec('c.center')} AS center, round(obj.cost, {Q.SCALAR_DIGITS}) AS cost FROM {final} c JOIN obj ON true"
    return _with(ctes, body)


def _coreset_ctes() -> tuple[list[str], str]:
    """Round 1: ``part, label, center, w`` in CTE ``core``."""
    ctes = [
        "pts AS MATERIALIZED (SELECT "
        f"{_bucket(Q.PARTS, Q.SEED, 'vec_id')} AS part, vec_id AS id, embedding::DOUBLE[] AS v, 1.0::DOUBLE AS w "
        "FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)"
    ]
    sctes, chosen = _seed_ctes("pts", Q.K, Q.SEED, "r1s_")
    ctes += sctes
    ctes.append(f"r1seeds AS MATERIALIZED (SELECT part, label, v AS center FROM {chosen})")
    lctes, final, last = _lloyd_ctes("pts", "r1seeds", Q.CORESET_ITERATIONS, True, "r1l_")
    ctes += lctes
    ctes.append(
        f"""core AS MATERIALIZED (
  SELECT c.part, c.label, c.center, count(a.id) AS w
  FROM {final} c LEFT JOIN {last} a ON c.part = a.part AND c.label = a.label
  GROUP BY c.part, c.label, c.center)"""
    )
    return ctes, "core"


def _coreset_sql() -> str:
    ctes, core = _coreset_ctes()
    return _with(ctes, f"SELECT part, label, {_rvec('center')} AS center, w FROM {core}")


def _kmedian_mr_sql() -> str:
    ctes, core = _coreset_ctes()
    ctes.append(
        f"""cpts AS MATERIALIZED (
  SELECT 0 AS part, (part * {Q.K} + label)::BIGINT AS id, center AS v, w::DOUBLE AS w FROM {core} WHERE w > 0)"""
    )
    sctes, chosen = _seed_ctes("cpts", Q.K, Q.SEED, "r2s_")
    ctes += sctes
    ctes.append(f"r2seeds AS MATERIALIZED (SELECT part, label, v AS center FROM {chosen})")
    lctes, final, _ = _lloyd_ctes("cpts", "r2seeds", Q.CORESET_ITERATIONS, False, "r2l_")
    ctes += lctes
    ctes.append(
        f"""r3 AS MATERIALIZED (
  SELECT avg((SELECT min({_dist('q.v', 'c.center')}) FROM {final} c)) AS cost FROM pts q)"""
    )
    body = f"SELECT c.label, {_rvec('c.center')} AS center, round(r3.cost, {Q.SCALAR_DIGITS}) AS cost FROM {final} c JOIN r3 ON true"
    return _with(ctes, body)


def _cluster_weights() -> str:
    body = f"""SELECT s.label, round(coalesce(sum(a.w), 0.0), {Q.SCALAR_DIGITS}) AS weight
FROM seeds s LEFT JOIN a ON s.part = a.part AND s.label = a.label GROUP BY s.label"""
    return _with(_weighted_assign(), body)


SQL: dict[str, str] = {
    "max_value": "SELECT max(l_quantity)::DOUBLE AS max_value FROM lineitem",
    "max_value_sorted": "SELECT max(l_quantity)::DOUBLE AS max_value FROM lineitem",
    "normalize_by_max": f"""
SELECT event_id, round(value / (SELECT max(value) FROM events), {Q.SCALAR_DIGITS}) AS normalized
FROM events WHERE value IS NOT NULL""",
    "harmonic_mean": f"""
SELECT round(count(*) / sum(CASE WHEN x / mx = 0 THEN {_INF} ELSE 1.0 / (x / mx) END), {Q.SCALAR_DIGITS}) AS harmonic_mean
FROM (SELECT l_quantity AS x, (SELECT max(l_quantity) FROM lineitem) AS mx FROM lineitem WHERE l_quantity IS NOT NULL)""",
    "parse_numbers": """
SELECT l_orderkey, l_linenumber, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks)::DOUBLE AS x
FROM (SELECT l_orderkey, l_linenumber,
             list_filter(regexp_split_to_array(concat_ws(' ', l_quantity::VARCHAR, l_tax::VARCHAR), '\\s+'),
                         lambda t: t <> '') AS toks
      FROM lineitem)""",
    "lines": _LINES,
    "tokenize": f"""
SELECT doc_id, line_no, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS word
FROM (SELECT doc_id, line_no, {_words('line')} AS ws FROM ({_LINES}))""",
    "doc_term_counts": f"""
SELECT conv_id, turn, word, count(*) AS tf
FROM (SELECT conv_id, turn, unnest({_words('text')}) AS word FROM conversations WHERE text IS NOT NULL)
GROUP BY conv_id, turn, word""",
    "word_count": _WORD_COUNT,
    "word_count_salted": _WORD_COUNT,
    "word_count_partitioned": _WORD_COUNT,
    "distinct_word_count": f"SELECT count(*) AS distinct_words FROM ({_WORD_COUNT})",
    "avg_distinct_word_length": f"SELECT round(avg(length(word)), {Q.SCALAR_DIGITS}) AS avg_length FROM ({_WORD_COUNT})",
    "word_count_report": f"""
SELECT s.strategy, t.distinct_words, t.avg_length
FROM (VALUES ('word_count'), ('word_count_salted'), ('word_count_partitioned')) AS s(strategy),
     (SELECT count(*) AS distinct_words, round(avg(length(word)), {Q.SCALAR_DIGITS}) AS avg_length
      FROM ({_WORD_COUNT})) AS t""",
    "parse_points": f"SELECT vec_id AS id, {_rvec('embedding::DOUBLE[]')} AS v FROM embeddings",
    "assign_parts": f"SELECT vec_id, {_bucket(Q.PARTS, Q.SEED, 'vec_id')} AS part FROM embeddings",
    "seed_centers": _seed_centers_sql(),
    "assign_nearest": _assign_nearest_sql(),
    "cluster_sizes": _cluster_sizes_sql(),
    "cluster_weights": _cluster_weights(),
    "kmedian_cost": _kmedian_cost_sql(),
    "lloyd_step": _lloyd_step_sql(),
    "lloyd": _lloyd_sql(),
    "kmedian": _kmedian_sql(),
    "kmedian_with_cost": _kmedian_with_cost_sql(),
    "coreset": _coreset_sql(),
    "kmedian_mr": _kmedian_mr_sql(),
    "kmedian_weighted": _kmedian_weighted_sql(),
    "kmedian_cost_parted": _kmedian_cost_sql(),
    "spread_lines": _LINES,
    "read_documents": f"SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS doc_id, line AS text FROM ({_LINES})",
    "read_points": f"SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, {_rvec('embedding::DOUBLE[]')} AS v FROM embeddings",
    "kmedian_file": _kmedian_with_cost_sql(),
}
