"""Session settings for large loads. The caller owns the session."""

from math import ceil

TASK_BYTES = 256 * 1024 * 1024
# A shuffle has tasks x tasks blocks; beyond this many they get tiny and the
# driver's books of them large, so tasks grow instead.
MOST_TASKS = 40_000


def session_options(load_bytes: int | None = None, most_tasks: int = MOST_TASKS) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config(map=...)``.

    ``load_bytes`` is the expected size of the largest load. It sets how much a
    scan task reads and how many partitions a shuffle starts with. Adaptive
    execution merges those that turn out small, but splits none outside of
    skewed joins and rebalanced writes, so too few would spill. Where that would
    make more than ``most_tasks`` of them, each reads more; results are the same.
    """
    options = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.kryoserializer.buffer.max": "512m",
        # A load divides its rows among a few folders; so many files open at once save a sort.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    }
    if load_bytes is not None:
        per_task = max(TASK_BYTES, ceil(load_bytes / most_tasks))
        options |= {
            "spark.sql.files.maxPartitionBytes": str(per_task),
            "spark.sql.shuffle.partitions": str(max(200, ceil(load_bytes / per_task))),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        }
    return options
