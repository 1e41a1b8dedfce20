"""Raw text to typed rows, latest version of each natural key."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.functions import (
    epoch_to_timestamp,
    json_fragment,
    json_scalar,
    json_scalar_sql,
    parse_sql,
    safe_int,
)
from appkpi.operators import attach_lookup, keep_latest
from appkpi.operators.latest import LANDED_ROW
from appkpi.plans.contracts import CONTRACTS, Contract
from appkpi.sources.landing import METADATA


def media_type(media_source: str) -> Column:
    """Organic or paid; an unknown source counts as paid."""
    organic = F.lower(F.col(media_source)) == "organic"
    return F.when(organic, F.lit("organic")).otherwise(F.lit("paid"))


# Columns that are more than a typed raw column, computed on the typed rows.
EXTRAS: dict[str, dict[str, Callable[[], Column]]] = {
    "stg_appsflyer_installs": {"media_type": lambda: media_type("media_source")},
    "stg_moengage_campaigns": {
        "campaign_name": lambda: json_scalar("basic_details", "$.name"),
        "segment_tags": lambda: json_fragment("basic_details", "$.tags"),
    },
    "stg_moengage_campaign_stats": {
        "reachable_users_in_segment": lambda: safe_int(
            json_scalar_sql("delivery_funnel", "$.reachable_users_in_segment")
        ),
    },
    "stg_play_console_reviews": {
        "last_modified_at_ts": lambda: epoch_to_timestamp("last_modified_at"),
        "developer_reply_text": lambda: F.nullif("developer_reply_text", F.lit("")),
        "developer_reply_at_ts": lambda: epoch_to_timestamp("developer_reply_at"),
    },
}

# A raw column that was renamed upstream: older spelling first.
RENAMED = {("stg_appstore_app_downloads", "pre_order"): ("pre_order", "pre-order")}


def typed(raw: DataFrame, name: str, only: Collection[str] | None = None) -> DataFrame:
    """The contract's columns, typed. Columns the raw table lacks are NULL.

    ``only`` names the fields to type; the others keep their raw text, see :func:`typed_values`.
    """
    contract = CONTRACTS[name]
    types = {f.name.lower(): f.dataType.simpleString() for f in raw.schema.fields}

    def raw_column(column: str) -> str:
        return f"`{column}`" if column.lower() in types else "CAST(NULL AS STRING)"

    def read(field: tuple[str, ...]) -> str:
        alias, type_name, *source = field
        spellings = RENAMED.get((name, alias), (source[0] if source else alias,))
        text = ", ".join(raw_column(s) for s in spellings)
        text = f"coalesce({text})" if len(spellings) > 1 else text
        wanted = only is None or alias in only
        return f"{parse_sql(text, type_name) if wanted else text} AS `{alias}`"

    def load_column(column: str) -> str:
        wanted = METADATA[column]
        if types.get(column.lower()) == wanted:
            return column
        return f"{parse_sql(raw_column(column), wanted)} AS {column}"

    numbered = [LANDED_ROW] if contract.key and LANDED_ROW in raw.columns else []
    return raw.selectExpr(
        *[read(f) for f in contract.fields],
        *[load_column(c) for c in contract.load_columns],
        *numbered,
    )


def latest_typed(rows: DataFrame, name: str) -> DataFrame:
    """The latest version of each key of typed rows, with the number that settles ties if there is one."""
    contract: Contract = CONTRACTS[name]
    # load columns are constant within a load, so they cannot break a tie
    own = [f[0] for f in contract.fields if f[0] not in contract.key]
    return keep_latest(rows, contract.key, tie_break=own, sort_by_hash=contract.sort_by_hash)


def typed_values(rows: DataFrame, name: str) -> DataFrame:
    """Rows of which only the key is typed, with the other fields typed as well."""
    contract = CONTRACTS[name]
    values = {f[0]: f[1] for f in contract.fields if f[0] not in contract.key}
    return rows.selectExpr(
        *[f"{parse_sql(f'`{c}`', values[c])} AS `{c}`" if c in values else f"`{c}`" for c in rows.columns]
    )


def with_extras(rows: DataFrame, name: str) -> DataFrame:
    """Typed rows with the columns that are computed from them."""
    extras = EXTRAS.get(name)
    return rows.withColumns({c: f() for c, f in extras.items()}) if extras else rows


def stage(raw: DataFrame, name: str) -> DataFrame:
    """One staging table. Extras are computed after the de-duplication, on the rows kept.

    So are the values of rows that are numbered. Rows without a number settle ties by a hash of
    the typed values, which every row then needs.
    """
    key = CONTRACTS[name].key
    numbered = bool(key) and LANDED_ROW in raw.columns
    rows = typed(raw, name, only=key if numbered else None)
    if key:
        rows = latest_typed(rows, name).drop(LANDED_ROW)
    if numbered:
        rows = typed_values(rows, name)
    return with_extras(rows, name)


def stage_in_app_events(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """In-app events with their category. They carry no natural key and are not de-duplicated."""
    lookup = mapping.select("event_name", F.col("category").alias("event_category"))
    events = stage(raw, "stg_appsflyer_in_app_events")
    return attach_lookup(events, lookup, "event_name").select(*events.columns, "event_category")
