"""Sinks: exact shards, partitioned tables, artifacts, manifests and staging."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from almazara import files, schemas
from almazara.operators import quality
from almazara.operators.relational import numbered_shards

CODEC = "zstd"


def write_exact_shards(df: DataFrame, path: str, order: list[str], rows_per_shard: int) -> None:
    """Folders ``shard=N`` of exactly ``rows_per_shard`` rows (the last may have fewer), each one sorted file. SNK-01, SNK-03."""
    shards = numbered_shards(df, order, rows_per_shard)
    shards.repartition("shard").sortWithinPartitions("shard", *order).write.mode("overwrite").option("compression", CODEC).partitionBy("shard").parquet(path)


def write_rolling(df: DataFrame, path: str, max_rows: int) -> None:
    """Files of at most ``max_rows`` rows, without a shuffle. SNK-02, SNK-06, SNK-15."""
    df.write.mode("overwrite").option("compression", CODEC).option("maxRecordsPerFile", max_rows).parquet(path)


def write_by(df: DataFrame, path: str, columns: list[str], sort: list[str] | None = None, max_rows: int = 5_000_000, everything: str | None = None) -> None:
    """Folders by the values of columns; large values keep several files. SNK-04, SNK-05, LM-03.

    With ``sort`` rows are ranged by the columns and the sort, so a value that holds
    most rows is several sorted files, not one task. With ``everything`` all rows
    are also written to the folder of that name beside the others.
    """
    if sort:
        out = df.repartitionByRange(*columns, *sort).sortWithinPartitions(*columns, *sort)
    else:
        out = df.repartition(*columns, F.pmod(F.xxhash64(*df.columns), F.lit(8)))
    out.write.mode("overwrite").option("compression", CODEC).option("maxRecordsPerFile", max_rows).partitionBy(*columns).parquet(path)
    if everything:
        write_rolling(df, f"{path}{everything}", max_rows)


def write_tables(tables: dict[str, DataFrame], folder: str, max_rows: int = 1_000_000) -> dict[str, int]:
    """Several tables, each counted while it is written. SNK-07, SNK-16."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"rows_{name}")
        write_rolling(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder}/{name}", max_rows)
        counts[name] = seen.get["rows"]
    return counts


def atomic_json(value, path: str) -> None:
    """JSON file put in place at once. SNK-09, FN-31."""
    told = lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v)
    files.put_text(path, json.dumps(_finite(value), ensure_ascii=False, indent=2, default=told) + "\n")


def _finite(value):
    if isinstance(value, float):
        return value if value - value == 0 else None
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    return [_finite(v) for v in value] if isinstance(value, (list, tuple)) else value


def append_json_lines(df: DataFrame, path: str) -> None:
    """Rows appended as JSON lines. SNK-10."""
    df.write.mode("append").json(path)


def checksum_manifest(df_files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of files read by ``spark.read.format('binaryFile')``. SNK-11, FN-18."""
    return df_files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


#: Columns that hold the box of a row's geometry.
BOX = ("bbox_min_x", "bbox_min_y", "bbox_max_x", "bbox_max_y")


def geo_metadata(spark: SparkSession, path: str, *, geometry: str = "geometry", crs: str = "EPSG:4326", box: tuple[str, ...] = BOX) -> dict:
    """Sidecar with the geometry metadata of a table, worked out from its rows. SNK-08.

    Spark writes no key-value pairs of its own into footers. The box of the table
    is that of its rows' boxes; the kinds of geometry are told by their second to
    fifth bytes, little-endian.
    """
    df = spark.read.parquet(path)
    kinds = {"01000000": "Point", "02000000": "LineString", "03000000": "Polygon", "04000000": "MultiPoint", "05000000": "MultiLineString", "06000000": "MultiPolygon"}
    low_x, low_y, high_x, high_y = box
    found = df.agg(F.min(low_x), F.min(low_y), F.max(high_x), F.max(high_y), F.array_sort(F.collect_set(F.hex(F.substring(geometry, 2, 4))))).first()
    covering = {"xmin": [low_x], "ymin": [low_y], "xmax": [high_x], "ymax": [high_y]}
    column = {"encoding": "WKB", "geometry_types": [kinds[k] for k in found[4] if k in kinds], "crs": crs, "edges": "planar", "covering": {"bbox": covering}}
    if found[0] is not None:
        column["bbox"] = list(found[:4])
    value = {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}}
    atomic_json(value, f"{path}/_geo.json")
    return value


def stage(spark: SparkSession, processed: str, artifacts: str, target: str, report: DataFrame, card: str | None = None) -> list[dict]:
    """Copy tables, artifacts and card to a folder with a manifest; refused unless every check passed. SNK-12, SNK-13.

    Files are copied by the executors, each a task of its own list, from and to any
    file system; the driver holds their names only.
    """
    quality.gate(report)
    files.removed(target)
    listed = [(f"{source}/{name}", f"{folder}/{name}") for source, folder in ((processed, "data"), (artifacts, "artifacts")) for name, _ in files.files_under(source)]
    if listed:
        copies = spark.createDataFrame(listed, "source string, name string").repartition(min(len(listed), 1000), "source")

        def run(frames):
            for frame in frames:
                for source, name in zip(frame["source"], frame["name"]):
                    files.copied(source, f"{target}/{name}")
                yield frame[["name"]]

        copies.mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()
    if card is not None:
        files.put_text(f"{target}/README.md", card)
    manifest = [{"path": name, "bytes": size} for name, size in files.files_under(target)]
    atomic_json(manifest, f"{target}/UPLOAD_MANIFEST.json")
    return manifest


def export_schema(name: str, path: str) -> None:
    """Declared schema of a table as JSON."""
    atomic_json(schemas.export(name), path)
