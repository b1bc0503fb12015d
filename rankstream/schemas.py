"""Declared schemas for every layer; nothing is inferred at read time."""

from __future__ import annotations

import json

from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()
TIMESTAMP, DATE = T.TimestampType(), T.DateType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def array(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


IMAGE = struct(full=STRING, sprite=STRING, group=STRING, x=INT, y=INT, w=INT, h=INT)


def _catalogue(kind: str, entry: T.StructType) -> T.StructType:
    return struct(type=STRING, version=STRING, **{kind: array(entry)})


# One static catalogue document per kind; its array carries the kind's name.
CATALOGUES = {
    "champions": _catalogue("champions", struct(id=STRING, name=STRING, tier=INT, image=IMAGE)),
    "traits": _catalogue("traits", struct(id=STRING, name=STRING, image=IMAGE)),
    "items": _catalogue("items", struct(id=STRING, name=STRING)),
    "augments": _catalogue("augments", struct(id=STRING, name=STRING)),
}

LEAGUE_ENTRY = struct(
    puuid=STRING, summonerId=STRING, queueType=STRING, tier=STRING, rank=STRING,
    wins=INT, losses=INT, hotStreak=BOOLEAN,
)

COMPANION = struct(content_ID=STRING, item_ID=INT, skin_ID=INT, species=STRING)
TRAIT = struct(name=STRING, num_units=INT, tier_current=INT, tier_total=INT)
UNIT = struct(character_id=STRING, tier=INT, itemNames=array(STRING))
PARTICIPANT = struct(
    puuid=STRING, placement=INT, level=INT, gold_left=INT, time_eliminated=DOUBLE,
    total_damage_to_players=INT, partner_group_id=INT, augments=array(STRING),
    companion=COMPANION, traits=array(TRAIT), units=array(UNIT),
)
MATCH_DOCUMENT = struct(
    metadata=struct(match_id=STRING),
    info=struct(
        game_length=DOUBLE, tft_game_type=STRING, tft_set_core_name=STRING,
        participants=array(PARTICIPANT),
    ),
)

BRONZE_MATCH = T.StructType(
    [*struct(match_id=STRING, game_length=DOUBLE).fields, *PARTICIPANT.fields,
     *struct(outcome=STRING).fields]
)

LOG_RECORD = struct(
    puuid=STRING, timestamp=STRING, request_type=STRING, endpoint_path=STRING,
    status_code=INT, response_size=INT, response_time=INT,
)

# Fixed values of the record format: what a field takes when the record lacks it.
LOG_RECORD_DEFAULTS = {
    "puuid": "NONE",
    "timestamp": "NONE",
    "request_type": "NONE",
    "endpoint_path": "NONE",
    "status_code": 0,
    "response_size": 0,
    "response_time": 0,
}

WIRE_RECORD = struct(value=T.BinaryType())

BRONZE_LOG = struct(
    puuid=STRING, timestamp=TIMESTAMP, request_type=STRING, endpoint_path=STRING,
    status_code=INT, response_size=INT, response_time=INT, date=DATE,
)

SILVER_LOG = struct(
    puuid=STRING, timestamp=TIMESTAMP, request_type=STRING, status_code=INT, response_size=INT,
    response_time=INT, date=DATE, product=STRING, rp=INT, action=STRING,
)


def avro_record_schema(name: str = "logs") -> str:
    """The log record as an Avro schema string, for :func:`rankstream.sources.records.decode`."""
    fields = [
        {"name": f.name, "type": f.dataType.simpleString(), "default": LOG_RECORD_DEFAULTS[f.name]}
        for f in LOG_RECORD.fields
    ]
    return json.dumps({"type": "record", "name": name, "fields": fields})
