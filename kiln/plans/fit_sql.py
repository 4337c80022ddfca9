"""SQL twins of iterative fits, as generated text for the oracle engine.

``descent_sql``: coordinate descent of the elastic net on correlations, as a
recursive query. ``boosted_sql``: regression trees grown level by level, and
boosted, on cells (distinct feature values with their counts and sums).
"""

from __future__ import annotations


def correlations(xs: list[str], y: str) -> str:
    """Aggregates that ``descent_sql`` needs of rows with columns ``xs``, ``y``."""
    p = len(xs)
    out = [f"avg({y}) AS my, stddev_pop({y}) AS sy"]
    out += [f"avg({x}) AS m{i}, stddev_pop({x}) AS s{i}, corr({x}, {y}) AS r{i}" for i, x in enumerate(xs)]
    out += [f"corr({xs[i]}, {xs[j]}) AS g{i}_{j}" for i in range(p) for j in range(i + 1, p)]
    return ", ".join(out)


def descent_sql(p: int, source: str, keys: list[str], sweeps: int) -> str:
    """CTEs ending in ``fit(keys, a, b0, b1, ...)`` from a CTE ``source`` that has
    ``keys``, ``reg``, ``mix`` and the columns of ``correlations``."""
    def update(j):
        z = f"(c.r{j}" + "".join(f" - c.g{min(i, j)}_{max(i, j)} * {'n' if i < j else 'd.b'}{i}" for i in range(p) if i != j) + ")"
        t = "(c.mix * c.reg / c.sy)"
        return f"sign({z}) * greatest(abs({z}) - {t}, 0) / (1 + (1 - c.mix) * c.reg / c.sy) AS n{j}"

    k = ", ".join(keys)
    same = " AND ".join(f"c.{x} = d.{x}" for x in keys)
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS b{j}" for j in range(p))
    coef = ", ".join(f"d.b{j} * c.sy / c.s{j} AS b{j}" for j in range(p))
    start = " - ".join(["c.my", *[f"d.b{j} * c.sy / c.s{j} * c.m{j}" for j in range(p)]])
    return f"""d(step, {k}, {', '.join(f'b{j}' for j in range(p))}) AS (
  SELECT 0, {k}, {zeros} FROM {source}
  UNION ALL
  SELECT step + 1, {', '.join(f'd.{x}' for x in keys)}, {', '.join(f'n{j}' for j in range(p))}
  FROM (SELECT d.*, {', '.join(update(j) for j in range(p))} FROM d JOIN {source} c ON {same} WHERE step < {sweeps}) d),
fit AS (SELECT {', '.join(f'c.{x}' for x in keys)}, {start} AS a, {coef} FROM d JOIN {source} c ON {same} WHERE step = {sweeps})"""


def boosted_sql(p: int, depth: int, rounds: int = 1, rate: float = 0.1, classes: int = 0) -> str:
    """CTEs ending in ``grown`` from ``cell(f0, ..., n, s0, ...)``: cells with
    their rows and label sums (with ``classes``: the rows of each class).

    Every step of the recursion grows one level of one tree: prefix sums over
    each feature give the gain of every cut, each node takes its best one, and
    its cells go left or right. After the last level the leaf means are added to
    ``pred`` and the next round starts on what is left. ``grown`` has a row per
    cell and step: ``step, f0.., n, s0.., pred, node, feature, gain``."""
    t = max(classes, 1)
    fs, ss = [f"f{i}" for i in range(p)], [f"s{c}" for c in range(t)]
    keep = ", ".join([*fs, "n", *ss])
    target = [f"{s}" if classes else f"CASE WHEN step < {depth} THEN s0 ELSE 2 * (s0 - n * pred) END" for s in ss]
    value = "CASE k " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(fs)) + " END"
    chosen = "CASE bk " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(fs)) + " END"
    prefix = ", ".join(f"sum(r{c}) OVER upto AS l{c}, sum(r{c}) OVER whole AS t{c}" for c in range(t))
    score = " + ".join(f"l{c} * l{c} / nl + (t{c} - l{c}) * (t{c} - l{c}) / (nt - nl)" for c in range(t))
    before = " + ".join(f"t{c} * t{c} / nt" for c in range(t))
    last = f"(step + 1) % {depth} = 0"
    return f"""grown AS (
  SELECT 0 AS step, {keep}, CAST(0 AS DOUBLE) AS pred, CAST(1 AS BIGINT) AS node, -1 AS feature, CAST(0 AS DOUBLE) AS gain
  FROM cell
  UNION ALL
  SELECT step + 1, {keep},
         CASE WHEN {last} THEN pred + (CASE WHEN step < {depth} THEN 1 ELSE {rate!r} END) * sum(r0) OVER leaf / sum(n) OVER leaf
              ELSE pred END,
         CASE WHEN {last} AND step + 1 < {depth * rounds} THEN 1 ELSE child END, bk, bg
  FROM (SELECT *, CASE WHEN score IS NULL OR {chosen} <= bv THEN 2 * node ELSE 2 * node + 1 END AS child
        FROM (SELECT *, first_value(k) OVER best AS bk, first_value(v) OVER best AS bv, first_value(g) OVER best AS score,
                     first_value(g - ({before})) OVER best AS bg
              FROM (SELECT *, CASE WHEN nl < nt THEN {score} END AS g
                    FROM (SELECT *, sum(n) OVER upto AS nl, sum(n) OVER whole AS nt, {prefix}
                          FROM (SELECT grown.*, k, {value} AS v, {', '.join(f'{x} AS r{c}' for c, x in enumerate(target))}
                                FROM grown, (VALUES {', '.join(f'({i})' for i in range(p))}) f(k) WHERE step < {depth * rounds})
                          WINDOW upto AS (PARTITION BY node, k ORDER BY v), whole AS (PARTITION BY node, k)))
              WINDOW best AS (PARTITION BY node ORDER BY g DESC NULLS LAST, k, v))
        WHERE k = 0)
  WINDOW leaf AS (PARTITION BY child))"""
