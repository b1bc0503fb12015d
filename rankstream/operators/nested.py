"""Match documents to flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream.operators.dedupe import first_per_key

# Fixed values of the match feed.
SET_NAME = "TFTSet10"
GAME_TYPE = "standard"

SEAT = ("match_id", "placement", "puuid")
MATCH_KEY = ("match_id", "puuid")


def inline_array(documents: DataFrame, array: str) -> DataFrame:
    """One row per element of an array of structs, fields as columns."""
    return documents.selectExpr(f"inline(`{array}`)")


def project_match(documents: DataFrame) -> DataFrame:
    """The document's nested fields as top-level columns."""
    return documents.select(
        F.col("metadata.match_id").alias("match_id"),
        "info.game_length",
        "info.tft_game_type",
        "info.tft_set_core_name",
        "info.participants",
    )


def ranked_matches(
    matches: DataFrame, set_name: str = SET_NAME, game_type: str = GAME_TYPE
) -> DataFrame:
    """Matches of one set and one game type."""
    return matches.filter(
        (F.col("tft_set_core_name") == set_name) & (F.col("tft_game_type") == game_type)
    )


def solo_matches(matches: DataFrame) -> DataFrame:
    """Matches in which no participant belongs to a partner group."""
    no_partner = F.forall("participants", lambda p: p["partner_group_id"].isNull())
    return matches.filter(F.coalesce(no_partner, F.lit(True)))


def participants(matches: DataFrame) -> DataFrame:
    """One row per participant; a match without participants stays as one row of nulls."""
    return (
        matches.select("match_id", "game_length", F.explode_outer("participants").alias("participant"))
        .select("match_id", "game_length", "participant.*")
    )


def with_outcome(rows: DataFrame) -> DataFrame:
    """Adds ``outcome``: win for the first four places, else loss."""
    return rows.withColumn(
        "outcome", F.when(F.col("placement") < 5, F.lit("win")).otherwise(F.lit("loss"))
    )


def flatten_documents(
    documents: DataFrame, set_name: str = SET_NAME, game_type: str = GAME_TYPE
) -> DataFrame:
    """Match documents to participant rows with outcome, in one narrow plan."""
    wanted = solo_matches(ranked_matches(project_match(documents), set_name, game_type))
    return with_outcome(participants(wanted))


def dedupe_matches(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per match and player; ``columns`` names those wanted besides the key."""
    return first_per_key(rows, MATCH_KEY, ["placement"], columns)


def match_augments(rows: DataFrame, picks: int = 3) -> DataFrame:
    """The first ``picks`` augments as columns; missing ones are null."""
    return rows.select(
        *SEAT, *[F.get("augments", F.lit(i)).alias(f"augment{i + 1}") for i in range(picks)]
    )


def match_traits(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per trait; a board without traits stays as one row of nulls."""
    kept = [*SEAT, *carry]
    return rows.select(*kept, F.explode_outer("traits").alias("trait")).select(
        *kept,
        F.col("trait.name").alias("trait_id"),
        F.col("trait.num_units").alias("trait_unit_count"),
        F.col("trait.tier_current").alias("trait_tier"),
        F.col("trait.tier_total").alias("trait_tier_max"),
    )


def match_units(rows: DataFrame) -> DataFrame:
    """One row per unit and item slot; units without items give no row.

    ``unit_ordinal`` is the unit's place on the board: it keeps two equal units apart.
    """
    units = rows.select(*SEAT, F.posexplode_outer("units").alias("unit_ordinal", "unit"))
    return units.select(
        *SEAT,
        "unit_ordinal",
        F.col("unit.character_id").alias("unit_id"),
        F.col("unit.tier").alias("unit_tier"),
        F.posexplode("unit.itemNames").alias("pos", "item"),
    ).select(*SEAT, "unit_id", "item", "unit_tier", "pos", "unit_ordinal")


def match_summary(rows: DataFrame, nested: Sequence[str] = ("augments", "units", "traits", "companion")) -> DataFrame:
    """Participant rows without their nested parts."""
    return rows.drop(*nested)
