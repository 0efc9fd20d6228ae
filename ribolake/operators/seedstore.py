"""Panel indexes that outlive a session.

The seeds are a table bucketed and sorted by seed, so a join shuffles and sorts the reads'
k-mers only. A manifest beside them says what was indexed and how; another session
declares the table from it without reading the seeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .align import PanelIndex, build_index

MANIFEST = (
    "name string, release string, panels array<string>, k int, max_length int, tile int, seed_rows bigint, tile_rows bigint, "
    "has_panel boolean, strands string, buckets int"
)
SEEDS = "kmer BIGINT, panel STRING, ref_id STRING, tile BIGINT, at BIGINT, side TINYINT"


def save_index(index: PanelIndex, name: str, folder: str, release: str, buckets: int = 64) -> None:
    """Keep an index under ``folder``, which must be new; ``name`` names its seed table.

    ``buckets`` should be the number of shuffle partitions of the joins, or a multiple.
    """
    spark = index.seeds.sparkSession
    index.tiles.write.parquet(f"{folder}/tiles")
    # One file a bucket: without the exchange every task would write all of them.
    (
        index.seeds.repartition(buckets, "kmer").write.bucketBy(buckets, "kmer").sortBy("kmer")
        .option("path", f"{folder}/seeds").saveAsTable(_table(name))
    )
    panels = sorted(r[0] for r in index.tiles.select("panel").distinct().collect())  # names of panels, a few
    row = described(index) | {"name": name, "release": release, "panels": panels, "buckets": buckets}
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.json(f"{folder}/manifest")


def described(index: PanelIndex) -> dict:
    """The numbers and names of an index, without its tables."""
    return {f: getattr(index, f) for f in ("k", "max_length", "tile", "seed_rows", "tile_rows", "has_panel", "strands")}


def _table(name: str) -> str:
    return f"`{name}_seeds`"


def read_manifest(spark: SparkSession, folder: str) -> dict:
    row = spark.read.schema(MANIFEST).json(f"{folder}/manifest").first()
    if row is None:
        raise ValueError(f"no manifest under {folder}")
    return row.asDict()


def load_index(spark: SparkSession, folder: str) -> PanelIndex:
    """A kept index, in any session."""
    said = read_manifest(spark, folder)
    table, n = _table(said["name"]), said["buckets"]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({SEEDS}) USING parquet CLUSTERED BY (kmer) SORTED BY (kmer) INTO {n} BUCKETS "
        f"LOCATION '{folder}/seeds'"
    )
    place = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    if place.split(":")[-1].rstrip("/") != f"{folder}/seeds".split(":")[-1].rstrip("/"):
        raise ValueError(f"table {said['name']}_seeds is that of another folder: {place}")
    return PanelIndex(
        seeds=spark.table(table), tiles=spark.read.parquet(f"{folder}/tiles"),
        **{f: said[f] for f in ("k", "max_length", "tile", "seed_rows", "tile_rows", "has_panel", "strands")},
    )


def drop_index(spark: SparkSession, name: str) -> None:
    """Forget the table of an index; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(name)}")


def kept_or_built(
    spark: SparkSession, panel: DataFrame, name: str, folder: str, release: str, min_length: int = 15, max_length: int = 250,
) -> PanelIndex:
    """The kept index of a release of a panel, or a new one, which is then kept.

    A manifest of another release or of shorter reads is an error, not a silent rebuild.
    """
    try:
        said = read_manifest(spark, folder)
    except Exception as error:  # no manifest yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        save_index(build_index(panel, min_length=min_length, max_length=max_length), name, folder, release)
        said = read_manifest(spark, folder)
    if said["release"] != release or said["k"] > min_length or said["max_length"] < max_length:
        raise ValueError(f"{folder} keeps release {said['release']!r} for reads of {said['k']} to {said['max_length']} bases")
    return load_index(spark, folder)
