"""Boosted trees as plain SQL, a step per level: the oracle of the boosting queries.

Nothing here calls the engine but for its random draws of rows and columns, which are numbers
in the text. ``rows`` names a CTE with LocationCode, DateTime, label, fold and the features.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from sunledger.operators.boosting import CELLS, LEAST_GAIN, PRIME, BoostParams

D = "::DOUBLE"

#: Settings that the SQL can follow tree by tree: no early stopping, few trees.
SQL_BOOST = BoostParams(
    learning_rate=0.3, max_depth=3, subsample=0.9, colsample=0.8, rounds=3, patience=3, max_bins=32, reg_lambda=2.0
)


def _values(name: str, columns: str, rows: Sequence[Sequence]) -> str:
    body = ", ".join("(" + ", ".join(map(str, r)) + ")" for r in rows)
    if not body:
        nothing = ", ".join(f"NULL::INTEGER AS {c}" for c in columns.split(", "))
        return f"{name} AS (SELECT {nothing} WHERE false)"
    return f"{name} AS (SELECT * FROM (VALUES {body}) v({columns}))"


def preparation(rows: str, features: Sequence[str], folds: int, params: BoostParams) -> list[str]:
    """CTEs up to the binned rows ``b``, the constants ``k`` and the first margins."""
    width = len(features)
    listed = ", ".join(f'{{\'f\': {i}, \'x\': CAST("{c}" AS DOUBLE)}}' for i, c in enumerate(features))
    key = "CAST(LocationCode AS VARCHAR) || '|' || CAST(DateTime AS VARCHAR) || '|42'"
    return [
        f"""m AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY LocationCode, DateTime) AS id,
  dense_rank() OVER (ORDER BY CAST(LocationCode AS VARCHAR)) - 1 AS site,
  CAST('0x' || substr(md5({key}), 9, 7) AS BIGINT) AS draw FROM {rows})""",
        f"""long AS MATERIALIZED (SELECT id, c.f AS f, c.x AS x
  FROM (SELECT id, unnest([{listed}]) AS c FROM m))""",
        "spans AS (SELECT f, min(x) AS low, max(x) AS high FROM long GROUP BY f)",
        f"""cells AS (SELECT f, cell, count(*) AS n, min(x) AS x FROM (SELECT long.f, x,
    CASE WHEN high > low THEN least(CAST(floor((x - low) / (high - low) * {CELLS}{D}) AS BIGINT), {CELLS - 1})
    ELSE 0 END AS cell FROM long JOIN spans ON long.f = spans.f) GROUP BY f, cell)""",
        f"""counted AS (SELECT f, cell, x, count(*) OVER (PARTITION BY f) AS cells,
  floor(CAST((sum(n) OVER o - n) * {params.max_bins} AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY f) AS DOUBLE)) AS bucket
  FROM cells WINDOW o AS (PARTITION BY f ORDER BY cell))""",
        f"""cuts AS MATERIALIZED (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS j FROM (
  SELECT *, lag(bucket) OVER (PARTITION BY f ORDER BY cell) AS previous FROM counted)
  WHERE previous IS NOT NULL AND (cells <= {params.max_bins} OR bucket > previous))""",
        f"""b AS MATERIALIZED (SELECT long.id, long.f, coalesce(c.j, 0) + 1 AS bin
  FROM long ASOF LEFT JOIN cuts c ON long.f = c.f AND long.x >= c.x
  UNION ALL SELECT id, {width}, site FROM m)""",
        """reach AS (SELECT greatest(4 * (max(label) - min(label)), abs(min(label)), abs(max(label)), 1e-30) AS r,
  count(*) AS n FROM m)""",
        """k AS MATERIALIZED (SELECT pow(2.0, least(36 - ceil(log2(r)), 61 - ceil(log2(n)) - ceil(log2(r)))) AS scale,
  pow(2.0, least(36 - ceil(log2(r * r)), 61 - ceil(log2(n)) - ceil(log2(r * r)))) AS square_scale FROM reach)""",
        """folded AS (SELECT fold, CAST(sum(CAST(round_even(label * scale, 0) AS BIGINT)) AS BIGINT) AS g, count(*) AS n
  FROM m, k GROUP BY fold)""",
        f"""bases AS MATERIALIZED (SELECT model, CAST(sum(p.g) AS DOUBLE) / CAST(sum(p.n) AS DOUBLE) / any_value(scale) AS base
  FROM (SELECT CAST(unnest(range({folds})) AS INTEGER) AS model) o JOIN folded p ON model <> p.fold, k GROUP BY model)""",
        f"""offered AS (SELECT model, CAST(unnest(range({width} + (SELECT max(site) + 1 FROM m))) AS BIGINT) AS c
  FROM bases)""",
        "margin0 AS MATERIALIZED (SELECT model, id, base AS margin FROM bases, m)",
    ]


def _tree(t: int, folds: int, width: int, params: BoostParams) -> list[str]:
    draws = []
    for model in range(folds):
        rng = random.Random(f"{params.seed}|{model}|{t}")
        limit = PRIME if params.subsample >= 1 else int(params.subsample * PRIME)
        draws.append((model, rng.randrange(1, PRIME), rng.randrange(PRIME), limit))
    ctes = [
        _values(f"draw{t}", "model, a, o, top", draws),
        f"""picked{t} AS MATERIALIZED (SELECT model, c FROM offered QUALIFY row_number() OVER (PARTITION BY model
  ORDER BY md5('{params.seed}|' || model || '|{t}|' || c)) <= greatest(1, floor({params.colsample}{D} * count(*) OVER (PARTITION BY model))))""",
        f"drawn{t} AS (SELECT model, c AS f FROM picked{t} WHERE c < {width})",
        f"allowed{t} AS (SELECT model, c - {width} AS site FROM picked{t} WHERE c >= {width})",
        f"""at{t}_0 AS MATERIALIZED (SELECT g.model, g.id, 1 AS node, m.fold <> g.model
    AND (m.draw * CAST(d.a AS BIGINT) + d.o) % {PRIME} < d.top AS used,
  CAST(round_even((g.margin - m.label) * k.scale, 0) AS BIGINT) AS g
  FROM margin{t} g JOIN m ON g.id = m.id JOIN draw{t} d ON g.model = d.model, k)""",
    ]

    def merit(g: str, n: str) -> str:
        return f"(({g}) / scale) * (({g}) / scale) / (({n}) + {params.reg_lambda}{D})"

    for level in range(params.max_depth):
        here = f"{t}_{level}"
        ctes += [
            f"""hist{here} AS (SELECT a.model, a.node, b.f, b.bin, sum(a.g) AS g, count(*) AS n
  FROM at{here} a JOIN b ON a.id = b.id JOIN drawn{t} c ON c.model = a.model AND c.f = b.f
  WHERE a.used AND a.node >= {2**level} GROUP BY ALL
  UNION ALL SELECT a.model, a.node, b.f, coalesce(c.site, -1), sum(a.g), count(*)
  FROM at{here} a JOIN b ON a.id = b.id AND b.f = {width}
  LEFT JOIN allowed{t} c ON c.model = a.model AND c.site = b.bin
  WHERE a.used AND a.node >= {2**level} GROUP BY ALL)""",
            f"""sides{here} AS (SELECT model, node, f, bin, CAST(tg AS DOUBLE) AS tg, CAST(tn AS DOUBLE) AS tn,
  CAST(CASE WHEN f = {width} THEN tg - g ELSE rg END AS DOUBLE) AS gl, CAST(CASE WHEN f = {width} THEN tn - n ELSE rn END AS DOUBLE) AS nl
  FROM (SELECT *, sum(g) OVER w AS tg, sum(n) OVER w AS tn, sum(g) OVER o AS rg, sum(n) OVER o AS rn FROM hist{here}
  WINDOW w AS (PARTITION BY model, node, f), o AS (PARTITION BY model, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING)))""",
            f"""best{here} AS MATERIALIZED (SELECT * FROM (SELECT model, node, f, bin,
    {merit('gl', 'nl')} + {merit('tg - gl', 'tn - nl')} - {merit('tg', 'tn')} AS gain
    FROM sides{here}, k WHERE nl >= 1 AND tn - nl >= 1 AND bin >= 0{" AND tn >= 2" if level else ""})
  WHERE gain > {LEAST_GAIN}{D} QUALIFY row_number() OVER (PARTITION BY model, node ORDER BY gain DESC, f, bin) = 1)""",
            f"""at{t}_{level + 1} AS MATERIALIZED (SELECT a.model, a.id, a.used, a.g,
  CASE WHEN s.f IS NULL THEN a.node WHEN (s.f = {width} AND b.bin = s.bin) OR (s.f < {width} AND b.bin > s.bin)
    THEN 2 * a.node + 1 ELSE 2 * a.node END AS node
  FROM at{here} a LEFT JOIN best{here} s ON a.model = s.model AND a.node = s.node
  LEFT JOIN b ON b.id = a.id AND b.f = s.f)""",
        ]
    last = f"at{t}_{params.max_depth}"
    ctes += [
        f"""leaf{t} AS MATERIALIZED (SELECT model, node, count(*) AS n,
  {params.learning_rate}{D} * (-(CAST(CAST(sum(g) AS BIGINT) AS DOUBLE) / any_value(scale)) / (count(*) + {params.reg_lambda}{D})) AS value
  FROM {last}, k WHERE used GROUP BY model, node)""",
        f"""margin{t + 1} AS MATERIALIZED (SELECT g.model, g.id, g.margin + coalesce(l.value, 0.0{D}) AS margin
  FROM margin{t} g JOIN {last} a ON g.model = a.model AND g.id = a.id
  LEFT JOIN leaf{t} l ON l.model = a.model AND l.node = a.node)""",
    ]
    return ctes


def boosting(rows: str, features: Sequence[str], folds: int, params: BoostParams) -> list[str]:
    """All CTEs of a fit; ``kept`` has the trees that each fold keeps, ``fitted`` its margins.

    Patience must not be less than the rounds: all trees are grown, then the best number kept.
    """
    ctes = preparation(rows, features, folds, params)
    for t in range(params.rounds):
        ctes += _tree(t, folds, len(features), params)
    every = " UNION ALL ".join(f"SELECT {t} AS t, * FROM margin{t}" for t in range(1, params.rounds + 1))
    return [
        *ctes,
        f"margins AS MATERIALIZED ({every})",
        """errors AS (SELECT model, t, CAST(sum(CAST(round_even((margin - label) * (margin - label) * square_scale, 0) AS BIGINT)) AS DOUBLE)
  / any_value(square_scale) / count(*) AS error FROM margins g JOIN m ON g.id = m.id AND g.model = m.fold, k GROUP BY model, t)""",
        f"""kept AS MATERIALIZED (SELECT b.model, coalesce(e.t, {params.rounds}) AS t FROM bases b LEFT JOIN (SELECT model, t FROM errors
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY error, t) = 1) e ON b.model = e.model)""",
        "fitted AS (SELECT g.model, g.id, g.margin FROM margins g JOIN kept ON g.model = kept.model AND g.t = kept.t)",
    ]


def node_rows(features: Sequence[str], params: BoostParams, site_column: str) -> str:
    """A SELECT of the nodes: model, tree, node, feature, cut, category, value."""
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate([*features, site_column]))
    parts = []
    for t in range(params.rounds):
        for level in range(params.max_depth):
            parts.append(
                f"""SELECT s.model, {t} AS tree, s.node, CASE s.f {names} END AS feature, c.x AS cut,
  CASE WHEN s.f = {len(features)} THEN (SELECT any_value(CAST(LocationCode AS VARCHAR)) FROM m WHERE m.site = s.bin) END AS category,
  0.0{D} AS value FROM best{t}_{level} s LEFT JOIN cuts c ON c.f = s.f AND c.j = s.bin"""
            )
        parts.append(f"SELECT model, {t}, node, NULL, NULL, NULL, value FROM leaf{t}")
    return "SELECT v.* FROM (" + "\nUNION ALL ".join(parts) + ") v JOIN kept ON v.model = kept.model AND v.tree < kept.t"


def scores(rows: str, features: Sequence[str], folds: int, params: BoostParams) -> list[str]:
    """CTEs that end in ``scored``: the mean of all models for every row of ``rows``.

    An absent or null feature counts as 0, and a site that was not trained has no category.
    """
    width = len(features)
    listed = ", ".join(f"{{'f': {i}, 'x': coalesce(CAST(\"{c}\" AS DOUBLE), 0.0{D})}}" for i, c in enumerate(features))
    ctes = [
        f"s AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM {rows})",
        f"sx AS MATERIALIZED (SELECT id, c.f AS f, c.x AS x FROM (SELECT id, unnest([{listed}]) AS c FROM s))",
        "sites_of AS (SELECT DISTINCT LocationCode, site FROM m)",
        "ss AS MATERIALIZED (SELECT s.id, t.site FROM s LEFT JOIN sites_of t ON s.LocationCode = t.LocationCode)",
        "total0 AS (SELECT model, id, base AS margin FROM bases, s)",
    ]
    for t in range(params.rounds):
        ctes.append(f"walk{t}_0 AS (SELECT model, id, 1 AS node FROM bases, s)")
        for level in range(params.max_depth):
            ctes.append(
                f"""walk{t}_{level + 1} AS MATERIALIZED (SELECT a.model, a.id, CASE WHEN q.f IS NULL THEN a.node
  WHEN (q.f = {width} AND coalesce(z.site = q.bin, false)) OR (q.f < {width} AND x.x >= c.x) THEN 2 * a.node + 1
  ELSE 2 * a.node END AS node FROM walk{t}_{level} a LEFT JOIN best{t}_{level} q ON a.model = q.model AND a.node = q.node
  LEFT JOIN cuts c ON c.f = q.f AND c.j = q.bin LEFT JOIN sx x ON x.id = a.id AND x.f = q.f JOIN ss z ON z.id = a.id)"""
            )
        ctes.append(
            f"""total{t + 1} AS MATERIALIZED (SELECT g.model, g.id, g.margin + coalesce(l.value, 0.0{D}) AS margin
  FROM total{t} g JOIN walk{t}_{params.max_depth} a ON g.model = a.model AND g.id = a.id
  LEFT JOIN leaf{t} l ON l.model = a.model AND l.node = a.node)"""
        )
    every = " UNION ALL ".join(f"SELECT {t} AS t, * FROM total{t}" for t in range(1, params.rounds + 1))
    ctes += [
        f"totals AS ({every})",
        f"""scored AS (SELECT s.LocationCode, s.DateTime, v.score FROM s JOIN (
  SELECT id, sum(margin) / {folds}{D} AS score FROM totals g JOIN kept ON g.model = kept.model AND g.t = kept.t
  GROUP BY id) v ON s.id = v.id)""",
    ]
    return ctes
