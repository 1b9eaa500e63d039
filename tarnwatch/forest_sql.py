"""The isolation forest in DuckDB SQL: the same draws, trees and path lengths as `operators/forest.py`."""

from __future__ import annotations

import math

import numpy as np

from .constants import SEED
from .operators.forest import (
    DIGITS, HALF, PATH_UNIT, PRIME, SAMPLE, STEP, TREES,
)


def _number(text: str, k: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {k * DIGITS + 1}, {DIGITS}) AS BIGINT)"


def forest_ctes(source: str, features: list[str], fit_on: str = "true", score_on: str = "true",
                trees: int = TREES, sample_size: int = SAMPLE, seed: int = SEED) -> str:
    """CTEs that end in `forest_raw` (incident_id, raw, fitted): a forest fitted to the rows of
    `source` where `fit_on` holds, applied to those where `fit_on` or `score_on` holds.

    `forest_rows` tells which rows were fitted.
    """
    inputs = ", ".join(f"floor(coalesce(CAST({f} AS DOUBLE), 0) * {float(STEP)} + {HALF}) / {float(STEP)}" for f in features)
    limit = math.ceil(math.log2(sample_size))
    mean = (f"CASE WHEN n > 2 THEN 2 * (ln(n - 1) + {np.euler_gamma!r}) - 2 * (n - 1)::DOUBLE / n "
            "WHEN n = 2 THEN 1.0 ELSE 0.0 END")
    path = f"floor((depth + {mean}) * {PATH_UNIT}.0 + 0.5)::BIGINT"
    levels = []
    for k in range(limit):
        levels.append(f"""
forest_range{k} AS MATERIALIZED (
  SELECT tree, node, f, min(x) AS low, max(x) AS high FROM forest_at{k} JOIN forest_long USING (incident_id) GROUP BY 1, 2, 3),
forest_cut{k} AS MATERIALIZED (
  SELECT tree, node, f, low + (high - low) * ({_number(f"'{seed}|grow|' || tree || '|' || node", 1)} / 268435456.0::DOUBLE) AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY f) - 1 AS place,
          count(*) OVER (PARTITION BY tree, node) AS many FROM forest_range{k} WHERE high > low AND {k} < (SELECT deepest FROM forest_size))
  WHERE place = {_number(f"'{seed}|grow|' || tree || '|' || node", 0)} % many),
forest_at{k + 1} AS MATERIALIZED (
  SELECT a.tree, CASE WHEN x <= cut THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node, a.incident_id
  FROM forest_at{k} a JOIN forest_cut{k} USING (tree, node) JOIN forest_long l ON l.incident_id = a.incident_id AND l.f = forest_cut{k}.f)""")
    cuts = " UNION ALL ".join(f"SELECT * FROM forest_cut{k}" for k in range(limit))
    sizes = " UNION ALL ".join(
        f"SELECT {k} AS depth, tree, node, count(*) AS n FROM forest_at{k} GROUP BY ALL" for k in range(limit + 1))
    return f"""
forest_rows AS MATERIALIZED (
  SELECT incident_id, [{inputs}] AS v, {fit_on} AS fitted FROM {source} WHERE ({fit_on}) OR ({score_on})),
forest_long AS MATERIALIZED (
  SELECT incident_id, f, v[f + 1] AS x FROM (SELECT incident_id, v, unnest(range({len(features)})) AS f FROM forest_rows)),
forest_lines AS (
  SELECT t AS tree, {", ".join(f"1 + {_number(f"'{seed}|draw|' || t", k)} AS {name}" for k, name in enumerate(("a1", "b1", "a2", "b2")))}
  FROM range({trees}) r(t)),
forest_keys AS (
  SELECT incident_id, {", ".join(f"{_number(f"'{seed}|' || incident_id", k)} AS h{k + 1}" for k in (0, 1))} FROM forest_rows WHERE fitted),
forest_size AS MATERIALIZED (
  SELECT ceil(log2(greatest(n, 2))) AS deepest, coalesce(nullif({mean}, 0), 1) * {PATH_UNIT * trees} AS scale
  FROM (SELECT least({sample_size}, count(*)) AS n FROM forest_keys)),
forest_at0 AS MATERIALIZED (
  SELECT tree, 0::BIGINT AS node, incident_id FROM forest_keys, forest_lines
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (h1 * a1 + b1) % {PRIME}, (h2 * a2 + b2) % {PRIME}, incident_id) <= {sample_size}),
{",".join(levels).strip()},
forest_cuts AS MATERIALIZED ({cuts}),
forest_leaves AS MATERIALIZED (
  SELECT tree, node, {path} AS path FROM ({sizes}) ANTI JOIN forest_cuts USING (tree, node)),
forest_walk0 AS (SELECT tree, 0::BIGINT AS node, incident_id FROM forest_rows, forest_lines),
{", ".join(f"""forest_walk{k + 1} AS MATERIALIZED (
  SELECT w.tree, CASE WHEN c.node IS NULL THEN w.node WHEN l.x <= c.cut THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END AS node,
    w.incident_id FROM forest_walk{k} w LEFT JOIN forest_cut{k} c ON c.tree = w.tree AND c.node = w.node
  LEFT JOIN forest_long l ON l.incident_id = w.incident_id AND l.f = c.f)""" for k in range(limit))},
forest_raw AS MATERIALIZED (
  SELECT incident_id, -pow(2.0::DOUBLE, -(sum(path)::BIGINT / (SELECT scale FROM forest_size)::DOUBLE)) AS raw
  FROM forest_walk{limit} JOIN forest_leaves USING (tree, node) GROUP BY 1)"""


def verdict_ctes(source: str, features: list[str], contamination: float, fit_on: str = "true",
                 score_on: str = "true") -> str:
    """`forest_ctes`, and `judged`: the scored rows of a source like `features` with anomaly_score, risk_score and if_anomaly."""
    return forest_ctes(source, features, fit_on, score_on) + f""",
forest_cutoff AS (
  SELECT quantile_cont(raw, {contamination}) AS q FROM forest_raw JOIN forest_rows USING (incident_id) WHERE fitted),
judged AS (
  SELECT s.* EXCLUDE (risk_score), raw - q AS anomaly_score, q - raw AS risk_score, CASE WHEN raw - q < 0 THEN 1 ELSE 0 END::INTEGER AS if_anomaly
  FROM {source} s JOIN forest_raw USING (incident_id), forest_cutoff WHERE {score_on})"""
