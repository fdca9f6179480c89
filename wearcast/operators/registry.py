"""Run and model-version tables (R1-R9) as plain DataFrames.

A model registry is a table ``(name, version, f1, …)`` and experiment runs
are a table ``(run_id, start_time, algorithm, f1, …)``; promotion and alias
decisions are window/aggregate queries over them instead of service calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .prefix import running_totals


def champion_decisions(versions: DataFrame, name: str = "name", version: str = "version",
                       metric: str = "f1") -> DataFrame:
    """Versions in order; a version is promoted iff its metric is strictly
    above the current champion's (none = 0.0).  The champion's metric is the
    running maximum of the earlier versions, so this is a running max per
    model — computed with distributed running totals, not a per-model
    window (one model may own a third of all versions)."""
    ranked = running_totals(versions.select(name, version, metric), [name], [version], [metric], how="max",
                            suffix="_champion")
    champ = F.greatest(F.coalesce(F.col(f"{metric}_champion"), F.lit(0.0)), F.lit(0.0))
    return ranked.select(
        name, version, metric,
        champ.alias("champion_f1_before"),
        (F.col(metric) > champ).alias("promoted"),
    )


def current_aliases(decisions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """Per model: champion = last promoted version, previous = the promoted
    one before it, candidate = newest version.  Two aggregations (partial,
    map-side) and a join on the model name; no per-model sort."""
    base = decisions.groupBy(name).agg(
        F.max(F.when(F.col("promoted"), F.col(version))).alias("champion"),
        F.max(version).alias("candidate"),
    )
    prev = decisions.where("promoted").join(base.select(name, "champion"), name).where(
        F.col(version) < F.col("champion")).groupBy(name).agg(F.max(version).alias("previous"))
    return base.join(prev, name, "left").select(name, "champion", "previous", "candidate")


def newest_experiment(runs: DataFrame, experiment: str = "experiment", start: str = "start_time") -> DataFrame:
    """The runs of the experiment that began last (its first run; ties to the
    larger name)."""
    began = runs.groupBy(experiment).agg(F.min(start).alias("_began"))
    newest = began.agg(F.max(F.struct("_began", experiment)).alias("_m")).select(F.col(f"_m.{experiment}").alias("_newest"))
    return runs.join(F.broadcast(newest), F.col(experiment) == F.col("_newest")).drop("_newest")  # one row


def recent_runs(runs: DataFrame, now: F.Column | None = None, minutes: int = S.RUN_WINDOW_MINUTES,
                limit: int | None = S.RUN_LIMIT, start: str = "start_time", run_id: str = "run_id") -> DataFrame:
    """Runs started in the last ``minutes`` before ``now``; with ``limit`` the
    newest of them (the listing: a top-k, not a full sort), without it all
    (what counts and lookups read).  ``now`` defaults to the newest start time
    in the table (a scalar subquery)."""
    if now is None:
        latest = runs.agg(F.max(start).alias("_now"))
        base = runs.crossJoin(F.broadcast(latest))  # one row
        now = F.col("_now")
    else:
        base = runs.withColumn("_now", now)
        now = F.col("_now")
    recent = base.where(F.col(start) >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")).drop("_now")
    return recent if limit is None else recent.orderBy(F.desc(start), F.desc(run_id)).limit(limit)


def main_run(recent: DataFrame, tag_col: str = "algorithm", tag_value: str = "model_comparison",
             metrics: tuple[str, ...] = ("f1",), labels: tuple[str, ...] = (), start: str = "start_time") -> DataFrame:
    """The newest recent run carrying the tag, with its metrics (0 when no
    such run exists) and text fields (NULL then): one row."""
    hit = recent.where(F.col(tag_col) == tag_value)
    newest = hit.agg(F.max_by(F.struct("run_id", *metrics, *labels), F.struct(start, "run_id")).alias("m"))
    return newest.select(
        F.col("m.run_id").alias("run_id"),
        *[F.coalesce(F.col(f"m.{m}"), F.lit(0.0)).alias(m) for m in metrics],
        *[F.col(f"m.{c}").alias(c) for c in labels],
    )


def runs_per_algorithm(recent: DataFrame, tag_col: str = "algorithm") -> DataFrame:
    return recent.where(F.col(tag_col).isNotNull()).groupBy(tag_col).agg(F.count("*").alias("runs"))


def latest_versions(versions: DataFrame, name: str = "name", version: str = "version",
                    metric: str = "f1", fields: tuple[str, ...] = ()) -> DataFrame:
    """Per model the newest version with its metric and further ``fields``
    (such as its stage and creation time)."""
    return versions.groupBy(name).agg(F.max(version).alias("latest_version"),
                                      *[F.max_by(c, version).alias(c) for c in (metric, *fields)])


def serving_version(aliases: DataFrame, name: str = "name") -> DataFrame:
    """Champion when there is one, else the highest version."""
    return aliases.select(name, F.coalesce("champion", "candidate").alias("serving_version"),
                          F.col("champion").isNotNull().alias("is_champion"))


def registry_listing(models: DataFrame, versions: DataFrame, aliases: DataFrame, name: str = "name",
                     version: str = "version", fields: tuple[str, ...] = ()) -> DataFrame:
    """Every model with all its versions, their ``fields`` (source, run id,
    status, tags) and each version's alias; models without versions keep one
    row with NULLs.

    Written as inner join ∪ anti join instead of ``models ⟕ versions``: one
    model may own a third of all versions, and adaptive skew handling can
    split a hot key of an inner join but not of the right side of a left
    outer join.  ``aliases`` has one row per model."""
    v = versions.join(aliases, name, "left").select(
        name, version, "f1", *fields,
        F.when(F.col(version) == F.col("champion"), "champion")
        .when(F.col(version) == F.col("previous"), "previous")
        .when(F.col(version) == F.col("candidate"), "candidate").alias("alias"),
    )
    with_versions = models.join(v, name, "inner")
    without = models.join(versions.select(name).distinct(), name, "left_anti").select(
        "*", F.lit(None).cast(versions.schema[version].dataType).alias(version),
        *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in ("f1", *fields)],
        F.lit(None).cast("string").alias("alias"))
    return with_versions.unionByName(without)


def production_gate(best: DataFrame, min_f1: float = S.PRODUCTION_MIN_F1, max_gap: float = S.PRODUCTION_MAX_GAP,
                    metric: str = "f1_score", gap: str = "gap") -> DataFrame:
    """quality_passed iff metric ≥ min_f1; production_ready iff also gap ≤
    max_gap; recommendations as text."""
    q = F.col(metric) >= min_f1
    g = F.col(gap) <= max_gap
    rec = F.concat_ws(
        "; ",
        F.when(q, F.format_string("F1 ok: %.4f", F.col(metric))).otherwise(
            F.format_string("F1 below minimum: %.4f < %s", F.col(metric), F.lit(str(min_f1)))),
        F.when(g, F.format_string("no overfitting: gap %.4f", F.col(gap))).otherwise(
            F.format_string("possible overfitting: gap %.4f > %s", F.col(gap), F.lit(str(max_gap)))),
    )
    return best.select("*", q.alias("quality_passed"), (q & g).alias("production_ready"),
                       rec.alias("recommendations"))
