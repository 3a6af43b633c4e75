"""Session settings that follow from the size of the job."""

from math import ceil

#: Bytes that a task reads of the columns it needs. They are few a row, and the
#: refresh folds four groups per session in memory, so this is a small split.
SPLIT_BYTES = 16 * 1024**2
#: Bytes that a task takes from a shuffle.
PARTITION_BYTES = 128 * 1024**2
#: No task of a shuffle takes more than this, however many map tasks there are.
LARGEST_PARTITION_BYTES = 1024**3
#: What a map task should hand to a task of the shuffle at least: below, a
#: shuffle is a great number of tiny reads.
BLOCK_BYTES = 16 * 1024


def settings_for(
    shuffle_bytes: int,
    cores: int,
    stored_bytes: int = 0,
    read_share: float = 1.0,
    split_bytes: int = SPLIT_BYTES,
) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about ``shuffle_bytes``.

    ``stored_bytes`` is the size of the events and ``read_share`` the part of
    it that the needed columns take. Input splits are sized by what is read of
    them, ``split_bytes``, so splits of wide files are large.

    The largest shuffle holds one row per session, so it grows with the events
    while all later ones stay small. The number of partitions given is the
    first one: adaptive execution merges those that turn out small but never
    splits those of an aggregate, hence the generous count.
    """
    split = ceil(split_bytes / max(read_share, 0.01))
    maps = max(1, ceil(stored_bytes / split))
    fitting = ceil(shuffle_bytes / PARTITION_BYTES)
    readable = ceil(shuffle_bytes / (maps * BLOCK_BYTES))
    least = ceil(shuffle_bytes / LARGEST_PARTITION_BYTES)
    partitions = max(cores, least, min(fitting, readable))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.session.timeZone": "UTC",
    }
