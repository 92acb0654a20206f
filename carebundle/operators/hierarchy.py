"""Care sites within care sites: the transitive closure of a relation, and access that reaches down it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.functions.keys import surrogate_key
from carebundle.operators.columns import quoted
from carebundle.sources.storage import stored

# Fixed values of the vocabulary: the domain of care sites, and the relationship "contains" between two of them.
CARE_SITE_DOMAIN = 57
CONTAINS = 46233689


def closure(edges: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """(ancestor, descendant, depth): all pairs connected by a path of edges, with the length of the shortest.

    Semi-naive rounds: each extends only the pairs that the round before found first, and stores those that are new, so a pair
    is met once and the rounds end when nothing is new, cycles or not.  A node on a cycle is its own descendant, see
    :func:`cyclic`.  Edges with a null end are left out; an edge given twice counts once.  There are as many rounds as
    the longest shortest path has edges.
    """
    step = edges.select(F.col(quoted(parent)).alias("ancestor"), F.col(quoted(child)).alias("descendant"))
    step = stored(step.where("ancestor is not null and descendant is not null").distinct(), "edges")
    known = new = stored(step.withColumn("depth", F.lit(1)), "closure")
    onwards = step.select(F.col("ancestor").alias("descendant"), F.col("descendant").alias("next"))
    depth = 1
    while not new.isEmpty():
        depth += 1
        longer = new.join(onwards, "descendant").select("ancestor", F.col("next").alias("descendant")).distinct()
        fresh = longer.join(known, ["ancestor", "descendant"], "left_anti")
        new = stored(fresh.withColumn("depth", F.lit(depth)), "closure")
        known = known.unionByName(new)
    return known


def cyclic(pairs: DataFrame) -> DataFrame:
    """(node, depth): the nodes of a closure that lie on a cycle, with the length of the shortest one."""
    return pairs.where("ancestor = descendant").select(F.col("ancestor").alias("node"), "depth")


def care_site_edges(bundle: Bundle) -> DataFrame:
    """(parent, child) of the care sites that contain others."""
    relations = bundle["fact_relationship"]
    sites = (F.col("domain_concept_id_1") == CARE_SITE_DOMAIN) & (F.col("domain_concept_id_2") == CARE_SITE_DOMAIN)
    contains = relations.where(sites & (F.col("relationship_concept_id") == CONTAINS))
    return contains.select(F.col("fact_id_1").alias("parent"), F.col("fact_id_2").alias("child"))


def with_inherited_grants(bundle: Bundle) -> Bundle:
    """The bundle with each grant at a care site repeated, its validity included, at all sites within it: what
    ``readable_persons`` and the other access checks find then reaches down the hierarchy.  A grant that a site has anyway is
    not repeated, and neither is one that would come back to its own site on a cycle."""
    grants = bundle["care_site_history"]
    pairs = closure(care_site_edges(bundle)).where("ancestor <> descendant").select("ancestor", "descendant")
    names = [name for name in grants.columns if name not in ("care_site_id", "care_site_history_id")]
    own = [F.col("descendant").alias("care_site_id"), *(F.col(quoted(name)) for name in names)]
    below = grants.join(pairs, F.col("care_site_id") == F.col("ancestor")).select(*own).distinct()
    condition = F.lit(True)
    held = grants.select(*(F.col(quoted(name)).alias(f"held {name}") for name in ("care_site_id", *names)))
    for name in ("care_site_id", *names):
        condition = condition & below[quoted(name)].eqNullSafe(held[quoted(f"held {name}")])
    fresh = below.join(held, condition, "left_anti")
    key = surrogate_key("care_site_history", [quoted(name) for name in ("care_site_id", *names)])
    rows = fresh.withColumn("care_site_history_id", key)
    return bundle.replace(care_site_history=grants.unionByName(rows, allowMissingColumns=True))
