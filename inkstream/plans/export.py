"""Stored tables written out: python -m inkstream.plans.export STORE FOLDER [--tables a,b] [--format csv|json]"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store as ST

#: Order of rows in an export, newest first; other tables come as they are stored.
ORDERS = {"items": ("ingested_at", "id"), "digests": ("week",), "cluster_signals": ("week", "topic_id")}


def flat(df: DataFrame) -> DataFrame:
    """df with nested columns as JSON text, which a CSV file can hold."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])


def export(spark: SparkSession, root: str, folder: str, names: list[str], how: str = "csv") -> list[str]:
    """The tables' files under folder, one subfolder each, and the subfolders' names; a table never stored gives an empty one."""
    made = []
    for name in names:
        df = ST.read(spark, root, name)
        if name in ORDERS:
            df = df.orderBy(*[F.col(c).desc_nulls_last() for c in ORDERS[name]])
        path = f"{folder}/{name}.{how}"
        ST.write_json(df, path) if how == "json" else ST.write_csv(flat(df), path)
        made.append(path)
    return made


def main(argv: list[str] | None = None) -> None:
    import argparse

    from ..session import get_spark

    p = argparse.ArgumentParser()
    p.add_argument("store")
    p.add_argument("folder")
    p.add_argument("--tables", default=",".join(ST.SCHEMAS))
    p.add_argument("--format", choices=("csv", "json"), default="csv")
    a = p.parse_args(argv)
    print("\n".join(export(get_spark("export"), a.store, a.folder, a.tables.split(","), a.format)))


if __name__ == "__main__":
    main()
