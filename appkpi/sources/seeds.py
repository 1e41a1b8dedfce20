"""The event-name lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MAPPING_SCHEMA = "event_name string, category string"

# App event name and the KPI category it counts towards.
EVENT_CATEGORIES = (
    ("SplashScreen_Loading", "open_app"),
    ("Login_PreLogin_Masuk", "login"),
    ("Login_BottomSheet_Masuk", "login"),
    ("BeliTE_TransaksiSukses", "purchase"),
    ("BayarGadai_TransaksiSukses", "purchase"),
    ("BayarAngsuran_TransaksiSukses", "purchase"),
    ("Onboarding_BuatPIN_Berhasil", "registrations"),
)


def event_mapping(spark: SparkSession) -> DataFrame:
    """The built-in lookup as a literal table.

    ``VALUES`` and not ``createDataFrame``: a local relation has a known size, so the join
    is planned as a broadcast, while rows from Python count as unboundedly large.
    """
    return literal_table(spark, EVENT_CATEGORIES, ("event_name", "category"))


def literal_table(
    spark: SparkSession, rows: Sequence[tuple[str, ...]], columns: Sequence[str]
) -> DataFrame:
    """A small all-text table that Spark knows the size of.

    The cells are named parameters: unnamed ones in ``VALUES`` are not bound in text order.
    """
    cells = {f"c{r}_{i}": v for r, row in enumerate(rows) for i, v in enumerate(row)}
    values = ", ".join(
        "(" + ", ".join(f":c{r}_{i}" for i in range(len(columns))) + ")" for r in range(len(rows))
    )
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})", args=cells)


def read_event_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A lookup kept as a CSV file with the header ``event_name,category``."""
    return spark.read.csv(path, schema=MAPPING_SCHEMA, header=True)
