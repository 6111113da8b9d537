"""Fixed schemas of the four event topics and of their raw (bronze) tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Topic:
    """One event topic: its message fields and the column order of its raw table.

    ``name`` is both the table name and the name of the newline-JSON files that
    carry the topic; the message-bus topic uses hyphens instead of underscores.
    """

    name: str
    fields: tuple[tuple[str, str], ...]
    bronze_columns: tuple[str, ...]
    renames: tuple[tuple[str, str], ...] = ()

    @property
    def bus_topic(self) -> str:
        return self.name.replace("_", "-")

    @property
    def message_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[t]) for n, t in self.fields])

    @property
    def bronze_schema(self) -> T.StructType:
        source = {new: old for old, new in self.renames}
        types = dict(self.fields) | {"event_date": "date"}
        return T.StructType(
            [T.StructField(c, _TYPES[types[source.get(c, c)]]) for c in self.bronze_columns]
        )


# Message fields and raw-table column orders of each topic.
LISTEN = Topic(
    name="listen_events",
    fields=(
        ("artist", "string"),
        ("auth", "string"),
        ("firstName", "string"),
        ("gender", "string"),
        ("itemInSession", "int"),
        ("lastName", "string"),
        ("duration", "double"),
        ("level", "string"),
        ("userAgent", "string"),
        ("registration", "bigint"),
        ("sessionId", "int"),
        ("song", "string"),
        ("ts", "bigint"),
        ("userId", "int"),
    ),
    bronze_columns=(
        "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level",
        "userAgent", "registration", "sessionId", "song", "ts", "userId", "event_date",
    ),
    renames=(("duration", "length"),),
)

PAGE_VIEW = Topic(
    name="page_view_events",
    fields=(
        ("auth", "string"),
        ("firstName", "string"),
        ("gender", "string"),
        ("itemInSession", "int"),
        ("lastName", "string"),
        ("level", "string"),
        ("method", "string"),
        ("page", "string"),
        ("registration", "bigint"),
        ("sessionId", "int"),
        ("status", "int"),
        ("ts", "bigint"),
        ("userId", "int"),
        ("userAgent", "string"),
        ("artist", "string"),
        ("song", "string"),
        ("duration", "double"),
    ),
    bronze_columns=(
        "auth", "firstName", "gender", "itemInSession", "lastName", "level", "method", "page",
        "registration", "sessionId", "status", "ts", "userId", "userAgent", "artist", "song",
        "length", "event_date",
    ),
    renames=(("duration", "length"),),
)

AUTH = Topic(
    name="auth_events",
    fields=(
        ("ts", "bigint"),
        ("sessionId", "int"),
        ("level", "string"),
        ("itemInSession", "int"),
        ("userId", "int"),
        ("lastName", "string"),
        ("firstName", "string"),
        ("gender", "string"),
        ("registration", "bigint"),
        ("success", "boolean"),
    ),
    bronze_columns=(
        "ts", "sessionId", "level", "itemInSession", "userId", "lastName", "firstName", "gender",
        "registration", "success", "event_date",
    ),
)

STATUS_CHANGE = Topic(
    name="status_change_events",
    fields=(
        ("auth", "string"),
        ("firstName", "string"),
        ("gender", "string"),
        ("itemInSession", "int"),
        ("lastName", "string"),
        ("level", "string"),
        ("registration", "bigint"),
        ("sessionId", "int"),
        ("ts", "bigint"),
        ("userId", "int"),
    ),
    bronze_columns=(
        "auth", "firstName", "gender", "itemInSession", "lastName", "level", "registration",
        "sessionId", "ts", "userId", "event_date",
    ),
)

TOPICS: dict[str, Topic] = {t.name: t for t in (LISTEN, PAGE_VIEW, AUTH, STATUS_CHANGE)}

# System pages that behaviour analysis leaves out.
EXCLUDED_PAGES = (
    "Error",
    "Upgrade",
    "Submit Upgrade",
    "Submit Downgrade",
    "Cancellation Confirmation",
    "Save Settings",
    "Submit Registration",
)
