"""Putting tables side by side and on top of each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_lookup(fact: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left join of a fact with a lookup table.

    There is no broadcast hint on purpose: Spark knows the size of a lookup file or of a
    ``VALUES`` table and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``. A
    lookup that has outgrown the threshold takes a sort-merge join whose hot event names
    adaptive execution splits. Rows made by ``createDataFrame`` have no known size; see
    ``sources.seeds.literal_table``.
    """
    return fact.join(lookup, on=on, how="left")


def full_outer_chain(inputs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer joins, one after another, on the running coalesced key.

    NULL keys match nothing, so such rows stay apart. Inputs may repeat a key.
    """
    return reduce(lambda left, right: left.join(right, on=list(keys), how="full"), inputs)


def merge_on_keys(
    inputs: Mapping[str, DataFrame],
    keys: Sequence[str],
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Full outer chain for inputs that hold each key once.

    Same rows as :func:`full_outer_chain`, from one union and one grouping instead of a
    sort-merge join per input. An outer join's result carries no usable partitioning, so a
    chain shuffles its growing left side again at every link; a union of inputs that are
    already hashed on the keys keeps that hashing and the grouping needs no shuffle.

    Rows with a NULL in the key are told apart by the input they come from, which is what
    "NULL matches nothing" means when every input holds a key once.

    An input that repeats a key is an error when the rows are made.

    ``required`` names inputs of which at least one must hold the key; the others then act
    as the right side of a left join.
    """
    keys = list(keys)
    has_null_key = " OR ".join(f"`{k}` IS NULL" for k in keys)
    values: dict[str, str] = {}
    for df in inputs.values():
        for field in df.schema.fields:
            if field.name not in keys:
                if field.name in values:
                    raise ValueError(f"column {field.name!r} comes from two inputs")
                values[field.name] = field.dataType.simpleString()

    def as_branch(position: int, name: str) -> DataFrame:
        own = set(inputs[name].columns)
        wanted = required is None or name in required
        return inputs[name].selectExpr(
            *[f"`{k}`" for k in keys],
            f"CASE WHEN {has_null_key} THEN {position} END AS __null_key_input",
            f"{str(wanted).upper()} AS __wanted",
            f"{1 << position}L AS __input",
            *[f"`{v}`" if v in own else f"CAST(NULL AS {t}) AS `{v}`" for v, t in values.items()],
        )

    stacked = union_branches(*[as_branch(i, n) for i, n in enumerate(inputs)])
    merged = stacked.groupBy(*keys, "__null_key_input").agg(
        F.expr("bool_or(__wanted) AS __wanted"),
        F.expr("sum(__input) = bit_or(__input) AS __once"),
        *[F.expr(f"max(`{v}`) AS `{v}`") for v in values],
    )
    # Two rows of one input would be mixed into one: stop instead.
    repeated = "CAST(raise_error('merge_on_keys: an input holds a key twice') AS BOOLEAN)"
    merged = merged.filter(f"CASE WHEN __once THEN TRUE ELSE {repeated} END")
    if required is not None:
        merged = merged.filter("__wanted")
    return merged.select(*keys, *values)


def union_branches(*branches: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), branches)
