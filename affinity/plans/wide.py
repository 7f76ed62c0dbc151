"""The 37-column user × event wide table."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.expressions import days_between, same_place
from affinity.operators.edges import friend_status_counts, has_edge
from affinity.plans.features import (
    DimFeatures,
    dedup_fact,
    dim_features,
    with_friend_ratios,
)
from affinity.schemas import FRIEND_STATUS, WIDE_COLUMNS, Dims, check_mode
from affinity.session import scratch_path, write_scratch

U, E = "userid", "eventid"


def creator_flags(pairs: DataFrame, feats: DimFeatures) -> DataFrame:
    """(userid, eventid, creator_is_friend) on the narrow pair keys: 1 iff the directed
    edge (host of the event -> user) exists. Pairs without it are left out, unless the event
    has several hosts: then there is a row for each."""
    several = feats.hosts.groupBy(E).agg((F.count(F.lit(1)) > 1).alias("_several"))
    keyed = pairs.select(U, E).join(feats.hosts.join(several, E), E)
    edges = feats.edges if feats.host_edges is None else feats.host_edges
    flagged = has_edge(keyed, edges, "host", U, "creator_is_friend")
    return flagged.where((F.col("creator_is_friend") == 1) | F.col("_several")).select(U, E, "creator_is_friend")


def pair_blocks(
    pairs: DataFrame, feats: DimFeatures, mode: str = "intended", staged: bool = False, below: Optional[str] = None
) -> dict[str, DataFrame]:
    """The pair-grain blocks, on the narrow pair keys: `friends` (on the event, by status) and,
    in intended mode, `flags` (the host edge). Both have rows only for pairs with a match (and
    for all pairs of an event with several hosts). `staged` writes the friends' candidates
    (to the folder `below`, if given)."""
    # Both read the same keys, so that Spark deals them by event once.
    keys = pairs.select(U, E).where(F.col(U).isNotNull() & F.col(E).isNotNull())
    blocks = {"friends": friend_status_counts(
        keys, feats.edges, feats.attendance, FRIEND_STATUS, feats.user_degree, feats.event_degree, staged, below
    )}
    if mode == "intended":
        blocks["flags"] = creator_flags(keys, feats)
    return blocks


def written_pair_blocks(
    pairs: DataFrame, feats: DimFeatures, mode: str = "intended", below: Optional[str] = None
) -> dict[str, DataFrame]:
    """The `pair_blocks` of written `pairs`, written one after the other."""
    blocks = pair_blocks(pairs, feats, mode, True, below)
    return {name: write_scratch(df, f"wide-{name}", below) for name, df in blocks.items()}


def assemble_wide(
    fact: DataFrame, feats: DimFeatures, mode: str = "intended", blocks: Optional[dict[str, DataFrame]] = None
) -> DataFrame:
    """Attach the dimension blocks to de-duplicated fact pairs, grain by grain.

    Grain: one row per fact pair whose user has a customer row and whose event has an
    events row and a group row with a non-NULL group type (inner joins).

    Order: the pair-grain blocks (friends on the event, host edge) are computed on the
    narrow pair keys and joined first, on (userid, eventid) — the partitioning the
    de-duplicated fact already has. The rows are then joined once with the pre-joined
    user block (on userid) and once with the pre-joined event block (on eventid).

    `blocks` are the `pair_blocks` where they are at hand.
    """
    check_mode(mode)
    pairs = fact.select(U, E, "invited", "times")
    blocks = pair_blocks(pairs, feats, mode) if blocks is None else blocks
    rows = pairs.join(blocks["friends"], [U, E], "left").fillna(0, subset=list(FRIEND_STATUS))
    if mode == "intended":
        rows = rows.join(blocks["flags"], [U, E], "left").fillna(0, subset=["creator_is_friend"])
    else:
        rows = rows.withColumn("creator_is_friend", F.lit(1))

    users = feats.users
    denominator = F.col("friend_count")
    if mode == "reference":
        users = users.join(pairs.groupBy(U).agg(F.count(F.lit(1)).alias("_fact_rows")), U)
        denominator = F.col("friend_count") * F.col("_fact_rows")
    rows = rows.join(users, U).join(feats.events, E).withColumns({
        "fri_count": denominator,
        # start_date is cast once per event in the event block
        "invite_days": F.coalesce(days_between("start_date", "times"), F.lit(0)),
    })
    rows = with_friend_ratios(rows)
    if mode == "intended":
        rows = rows.withColumn("location_similar", same_place("location", "city", "state", "country"))
    else:
        rows = rows.withColumn("location_similar", F.lit(0))

    renamed = {
        "user_id": F.col(U),
        "event_id": F.col(E),
        "user_invited": F.col("invited"),
        "uf_maybe_count": F.col("uf_maybe_attended_count"),
    }
    return rows.select(*[renamed.get(c, F.col(c)).alias(c) for c in WIDE_COLUMNS])


def build_wide(
    fact: DataFrame,
    dims: Dims,
    as_of=None,
    mode: str = "intended",
    dedup: bool = True,
    feats: Optional[DimFeatures] = None,
    staged: bool = False,
) -> DataFrame:
    """Fact feed + dimensions -> wide table. `feats` reuses precomputed dimension blocks.

    `staged`: the dimension blocks (but the event block, which the last step reads once), the de-duplicated pairs and then each pair-grain block are
    written to the shared checkpoint folder, one after the other. The files are a small part
    of the shuffles that make them, and the disk holds the shuffles of one step at a time.
    """
    check_mode(mode)
    pairs = dedup_fact(fact) if dedup else fact
    if not staged:
        return assemble_wide(pairs, feats if feats is not None else dim_features(dims, as_of, mode), mode)
    if feats is None:
        feats = dim_features(dims, as_of, mode).write(scratch_path(fact.sparkSession, "wide-dims"), lazy=("events",))
    pairs = write_scratch(pairs.select(U, E, "invited", "times"), "wide-pairs")
    return assemble_wide(pairs, feats, mode, written_pair_blocks(pairs, feats, mode))


