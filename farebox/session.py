"""A session with the settings the package is tested under.

Any session works: no operator depends on the session time zone, and none
needs a setting that is not Spark's default.
"""

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Single-machine session for tests and benchmarks, without the web page."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("farebox")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=settings or {})
        .getOrCreate()
    )
