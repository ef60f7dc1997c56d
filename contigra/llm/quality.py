"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model on text shape gives each document's evidence under the global rate of
good documents.  Grouped aggregation sums that evidence by path within host and by host.
Host rates shrink towards the global rate and path rates towards their host's rate;
how strongly is estimated by moments from how much rates differ beyond sampling noise,
so sparse sites lean on the level above.  A document's log odds move by what its
path's rate, as the other documents of the path and host show it, differs from the global rate.

The classifier is fitted on at most ``most`` labelled rows; site statistics are over all rows.

Defined cases: null or blank text has all features zero; null host or path is a group of its own;
without usable labels of both kinds the classifier gives even odds and everything is kept;
null or repeated doc_id and repeated rows are scored like any others; an empty table gives an empty
result; other columns pass through ``drop_rejected`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigra.llm.models import LABELLED, fit_logistic, labelled, map_text, shape, standardised
from contigra.llm.common import join_heavy, write_shared

KEEP = 0.5
BROADCAST_GROUPS = 50_000


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED):
    """A function of UTF-8 bytes that gives the log odds of a good document."""
    sample = map_text(labelled(docs, labels, "quality", most, "quality-labelled"), "x_", "array<double>", lambda t: shape(t).tolist(), pa.list_(pa.float64()))
    rows = sample.select("y_", "x_").toPandas()  # ``most`` rows at most
    if rows["y_"].nunique() < 2:
        return lambda text: 0.0
    x, y = np.array(rows["x_"].tolist()), rows["y_"].to_numpy()
    mean, scale = x.mean(0), x.std(0) + 1e-6
    weights, intercept = fit_logistic(standardised(x, mean, scale), y)
    return lambda text: float(np.clip(standardised(shape(text), mean, scale) @ weights + intercept, -30, 30))


def _strength(groups: DataFrame, n: str, rate: str, prior: str) -> float:
    """Pseudo-count of a beta prior, by moments of the rates around ``prior``."""
    r = groups.where(f"{n} > 1").agg(F.sum(n).alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.expr(f"{n} * ({rate} - {prior}) * ({rate} - {prior})")).alias("s"), F.avg(F.expr(f"{prior} * (1 - {prior})")).alias("v")).first()
    if not r["k"] or not r["v"]:
        return 10.0
    between = (r["s"] - r["k"] * r["v"]) / r["n"]
    return float(min(max(r["v"] / between - 1, 1.0), 1e4)) if between > 0 else 1e4


def _keys(host: str, path: str) -> list[Column]:
    """The site of a row, in which a null host or path is a value of its own."""
    return [F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), F.col(c).cast("string"))).alias(n) for c, n in ((host, "host_"), (path, "path_"))]


def sites(scored: DataFrame) -> tuple[DataFrame, float, float, float]:
    """Sums of p_ and rows by (host_, path_) and by host_, the global rate, and the strengths of the priors of hosts and paths."""
    paths = write_shared(scored.groupBy("host_", "path_").agg(F.count(F.lit(1)).cast("double").alias("pn_"), F.sum("p_").alias("ps_")), "quality-paths")
    total = paths.agg(F.sum("pn_").alias("n"), F.sum("ps_").alias("s")).first()
    rate = (total["s"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    hosts = paths.groupBy("host_").agg(F.sum("pn_").alias("hn_"), F.sum("ps_").alias("hs_"))
    k_host = _strength(hosts.withColumns({"hr_": F.expr("hs_ / hn_"), "g_": F.lit(rate)}), "hn_", "hr_", "g_")
    both = paths.join(hosts, "host_")
    posterior = F.expr(f"(hs_ + {k_host!r} * {rate!r}) / (hn_ + {k_host!r})")
    k_path = _strength(both.withColumns({"hp_": posterior, "pr_": F.expr("ps_ / pn_")}), "pn_", "pr_", "hp_")
    return write_shared(both, "quality-sites"), rate, k_host, k_path


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _judged(scored: DataFrame) -> DataFrame:
    """Rows (with host_, path_, evidence_, p_) and site_, the rate of the row's site as the other rows show it, and good_.

    A row's own evidence is taken out of the sums of its path and host before these are shrunk, so it counts once.  Few sites
    are broadcast; of many, those that hold more than a bounded share of the rows.
    """
    table, rate, k_host, k_path = sites(scored)
    n = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("pn_"), F.lit(0.0))).first()
    joined = scored.join(F.broadcast(table), ["host_", "path_"]) if n[0] <= BROADCAST_GROUPS else join_heavy(scored, table, ["host_", "path_"], "pn_", int(n[1]))
    host = (F.col("hs_") - F.col("p_") + k_host * rate) / (F.col("hn_") - 1 + k_host)
    joined = joined.withColumn("site_", (F.col("ps_") - F.col("p_") + k_path * host) / (F.col("pn_") - 1 + k_path))
    odds = F.col("evidence_") + _odds(F.col("site_")) - _odds(F.lit(rate))
    return joined.withColumn("good_", 1 / (1 + F.exp(-odds)))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep: float = KEEP, most: int = LABELLED) -> DataFrame:
    """doc_id, evidence (log odds), site_rate, p_good, keep: one row a row of ``docs``."""
    scored = map_text(docs.select("doc_id", "text", *_keys(host, path)), "evidence_", "double", fit(docs, labels, most), pa.float64())
    judged = _judged(write_shared(scored.withColumn("p_", 1 / (1 + F.exp(-F.col("evidence_")))), "quality-evidence"))
    return judged.select("doc_id", F.col("evidence_").alias("evidence"), F.col("site_").alias("site_rate"), F.col("good_").alias("p_good"), (F.col("good_") >= keep).alias("keep"))


def drop_rejected(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep: float = KEEP, most: int = LABELLED) -> DataFrame:
    """The documents that the classifier keeps, with all columns; evidence is computed once and written beside them."""
    own = [F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)]
    text = f"in_{docs.columns.index('text')}"
    scored = map_text(docs.select(*own, *_keys(host, path)), "evidence_", "double", fit(docs, labels, most), pa.float64(), of=text, keep=True)
    judged = _judged(write_shared(scored.withColumn("p_", 1 / (1 + F.exp(-F.col("evidence_")))), "quality-evidence"))
    return judged.where(F.col("good_") >= keep).select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
