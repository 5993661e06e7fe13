"""Items at rest in versions: a base in buckets, later batches beside it, and what belongs together.

::

    manifest/0000000003.json      version 3: the epochs that are in its base, and the folder of each bucket
    base/<folder>/bucket=7/       rows of one bucket, written by one compaction or upsert, never changed
    log/epoch=12/                 one batch, as it came

A reader takes the newest manifest and adds the finished epochs that are not yet
in its base. Compaction moves epochs into the base: it reads the buckets that
the epochs' keys fall into, keeps the rows that still provide a value, writes
these buckets to a new folder, and publishes the next manifest; all other
buckets keep their files. The manifest is the only switch: it appears whole
under a new name or not at all, and of two writers that start from one version
the second fails. Readers that opened before still find the files they listed,
until ``vacuum`` drops the versions they use.

The newest value wins by the batch number in the data, so an old batch that comes
late, after its key was compacted, changes what it would have changed before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import ITEM_KEY
from ..storage import AlreadyThere, discard, names_below, publish_text, read_text
from .upsert_stream import current_items, still_needed

#: Buckets of a new store. A bucket is what an upsert rewrites at least.
BUCKETS = 64


@dataclass
class Manifest:
    version: int
    through: int                    # last epoch that is in the base
    buckets: int
    folders: dict[str, str] = field(default_factory=dict)


class ItemStore:
    """Items below ``path`` with ``schema``: the natural key, the item columns and the batch number."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = f"{self.path}/log"
        if not self.versions():
            try:
                self._publish(Manifest(0, -1, buckets))
            except AlreadyThere:
                pass                # another writer made the store; its number of buckets holds

    # --- versions ---
    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names_below(self.spark, f"{self.path}/manifest") if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.versions()[-1] if version is None else version
        return Manifest(**json.loads(read_text(self.spark, self._manifest_path(version))))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifest/{version:010d}.json"

    def _publish(self, manifest: Manifest) -> Manifest:
        publish_text(self.spark, self._manifest_path(manifest.version), json.dumps(asdict(manifest)))
        return manifest

    # --- reading ---
    def epochs(self, after: int = -1) -> list[int]:
        """Finished epochs after the given one."""
        found = [int(n.removeprefix("epoch=")) for n in names_below(self.spark, self.log) if n.startswith("epoch=")]
        return [e for e in sorted(found) if e > after and "_SUCCESS" in names_below(self.spark, f"{self.log}/epoch={e}")]

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _base(self, manifest: Manifest, buckets: list[str] | None = None) -> DataFrame:
        wanted = manifest.folders if buckets is None else [b for b in buckets if b in manifest.folders]
        return self._rows([f"{self.path}/base/{manifest.folders[b]}/bucket={b}" for b in sorted(wanted, key=int)])

    def _log(self, epochs: list[int]) -> DataFrame:
        return self._rows([f"{self.log}/epoch={e}" for e in epochs])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version's base and of the finished epochs after it, as they are now; later switches don't change them."""
        manifest = self.manifest(version)
        return self._base(manifest).unionByName(self._log(self.epochs(manifest.through)))

    def current(self, version: int | None = None) -> DataFrame:
        """One row per natural key."""
        return current_items(self.read(version))

    # --- writing ---
    def append(self, batch: DataFrame, epoch: int) -> None:
        """Keep a batch; an epoch that comes again replaces itself, or is ignored once it is in the base."""
        if epoch > self.manifest().through:
            batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.log}/epoch={epoch}")

    def compact(self) -> Manifest:
        """Move all finished epochs into the base."""
        manifest = self.manifest()
        epochs = self.epochs(manifest.through)
        return self._rewrite(manifest, self._log(epochs), epochs[-1]) if epochs else manifest

    def upsert(self, rows: DataFrame) -> Manifest:
        """Put rows straight into the base; only the buckets of their keys are rewritten. The log stays as it is."""
        manifest = self.manifest()
        return self._rewrite(manifest, rows.select(*self.schema.names), manifest.through)

    def _bucket(self, manifest: Manifest) -> Column:
        return F.pmod(F.xxhash64(*ITEM_KEY), F.lit(manifest.buckets)).cast("int")

    def _rewrite(self, manifest: Manifest, new: DataFrame, through: int) -> Manifest:
        touched = sorted(str(r[0]) for r in new.select(self._bucket(manifest)).distinct().collect())      # as many as there are buckets at most
        folder = f"{manifest.version + 1}-{uuid.uuid4().hex}"
        path = f"{self.path}/base/{folder}"
        kept = still_needed(self._base(manifest, touched).unionByName(new)).withColumn("bucket", self._bucket(manifest))
        if touched:
            kept.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        try:
            return self._publish(Manifest(manifest.version + 1, through, manifest.buckets, manifest.folders | dict.fromkeys(touched, folder)))
        except AlreadyThere:
            discard(self.spark, path)
            raise

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions, with the buckets and epochs that none of the kept ones reads."""
        versions = self.versions()
        old, kept = versions[:-keep], [self.manifest(v) for v in versions[-keep:]]
        in_use = {(b, f) for m in kept for b, f in m.folders.items()}
        for version in old:
            for bucket, folder in self.manifest(version).folders.items():
                if (bucket, folder) not in in_use:
                    discard(self.spark, f"{self.path}/base/{folder}/bucket={bucket}")
            discard(self.spark, self._manifest_path(version))
        for epoch in self.epochs():
            if epoch <= min(m.through for m in kept):
                discard(self.spark, f"{self.log}/epoch={epoch}")


def run(store: ItemStore, source: str, checkpoint: str, files_per_trigger: int | None = None, compact_every: int = 16) -> None:
    """Append everything new below ``source`` to the store and stop; every so many epochs the log is compacted.

    Items hold at most one row per natural key and batch number.
    """
    reader = store.spark.readStream.schema(store.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def append(batch: DataFrame, epoch: int) -> None:
        store.append(batch, epoch)
        if (epoch + 1) % compact_every == 0:
            store.compact()

    query = (reader.parquet(source).writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
