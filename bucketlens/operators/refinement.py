"""Duplicates by exact bytes, by partition refinement.

Objects start as one class per size. Each round reads a little more of the
objects whose class still has others, and splits the classes by what it read:

1. the size (nothing is read; a unique size is alone, an empty object is known),
2. a probe: the first and the last block,
3. the full checksum.

So a large object is read in full only if another one has its size, its first
and its last block. Bytes read are at most two blocks for each object whose size
occurs again, plus the size of each object whose probe occurs again too.

The result has the shape and rules of ``duplicates.byte_classes``: what a round
tells apart is alone (its checksum stays NULL), an object without a size has a
NULL class, and a key listed twice is an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .duplicates import byte_classes, duplicate_files_bytes

Step = Callable[[DataFrame], DataFrame]


def refined(probe: Step, checksums: Step) -> Step:
    """A ``checksums`` function for ``byte_classes`` that asks ``probe`` first:
    ``probe`` maps (bucket_name, key, size) to the same plus ``probe``. Objects
    that the probe tells apart get a checksum of their own, the probe itself with
    their name, which equals no other.

    Both rounds run when it is called, and their (small) results are written to
    the session's scratch folder: each is read more than once later, and what was
    read from the objects must not be read again."""

    def run(candidates: DataFrame) -> DataFrame:
        probed = stored(probe(candidates), "probed")
        per = probed.groupBy("size", "probe").agg(F.count(F.lit(1)).alias("_k"))
        counted = probed.join(per, ["size", "probe"])
        alone = counted.where("_k = 1").select(
            "bucket_name", "key", "size", F.concat_ws("/", F.lit("probe"), "probe", "bucket_name", "key").alias("checksum")
        )
        tied = counted.where("_k > 1").select("bucket_name", "key", "size")
        full = stored(checksums(tied), "checksums")
        return alone.unionByName(full.select("bucket_name", "key", "size", "checksum"))

    return run


def refined_byte_classes(objects: DataFrame, probe: Step, checksums: Step) -> DataFrame:
    """``byte_classes`` by refinement; a probe's answer is no checksum, so what
    it told apart has a NULL one."""
    classes = byte_classes(objects, refined(probe, checksums))
    full = F.when(~F.col("checksum").startswith("probe/"), F.col("checksum"))
    return classes.withColumn("checksum", full)


def duplicate_files_refined(objects: DataFrame, probe: Step, checksums: Step) -> DataFrame:
    """``duplicate_files_bytes`` by refinement."""
    return duplicate_files_bytes(objects, refined(probe, checksums))
