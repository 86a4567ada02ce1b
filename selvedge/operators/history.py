"""History of changing attributes: one row per version of an entity with the period it was valid.

Snapshots are kept as runs: co-partitioned by entity into buckets, sorted by entity and time
within each, in files in the shared folder. A new snapshot is one more run, and costs the
exchange of its own rows only. `RunStore.versions` gives each bucket to a task, which opens
the runs of that bucket as iterators of batches and merges them k-way by entity and time,
closing a version wherever the payload changes. A task holds one batch of each run and the
open version of the entity it has come to, however long a history is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from selvedge.session import checkpoint_folder

#: Rows that a task reads ahead, shared among the runs it merges, and the most of one run.
AHEAD, BATCH = 1 << 20, 1 << 15
#: Rows a closed batch of versions has at least, but for the last.
OUT_ROWS = 50_000


def cents(price: str) -> Column:
    """A price in whole cents, half a cent rounded up; null for null, NaN and infinity."""
    x = F.col(price).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(9e15)), F.round(x * 100).cast("long"))


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


COLUMNS = ["entity", "time", "loaded", "payload"]


def _stored(c: str, kind: str) -> Column:
    """Times as microseconds, which every reader of the files takes for the same."""
    return F.unix_micros(F.col(c).cast("timestamp")).alias(c) if kind.startswith("timestamp") else F.col(c)


def _lexsorted(t: pa.Table) -> pa.Table:
    return t.take(pc.sort_indices(t, [(c, "ascending") for c in COLUMNS], null_placement="at_start"))


class _Run:
    """A sorted run, read batch by batch."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches
        self.held: pa.Table | None = None
        self.more()

    def more(self) -> bool:
        """Adds the next batch to what is held; False if there is none."""
        for b in self.batches:
            if b.num_rows:
                new = pa.Table.from_batches([b])
                self.held = new if self.held is None or not self.held.num_rows else pa.concat_tables([self.held, new])
                return True
        return False

    def last(self) -> tuple:
        t = self.held.slice(self.held.num_rows - 1)
        return t["entity"].to_numpy()[0], t["time"].to_numpy()[0]

    def taken(self, frontier: tuple) -> pa.Table:
        """The held rows up to the frontier, which are taken out."""
        e, t = self.held["entity"].to_numpy(), self.held["time"].to_numpy()
        n = int(np.searchsorted(e, frontier[0], "left"))
        end = int(np.searchsorted(e, frontier[0], "right"))
        n += int(np.searchsorted(t[n:end], frontier[1], "right"))
        out, self.held = self.held.slice(0, n), self.held.slice(n)
        return out


def merged(runs: list[Iterator[pa.RecordBatch]]) -> Iterator[pa.Table]:
    """The rows of sorted runs in one order, in tables that never part rows of one entity and time.

    The frontier is the least of the runs' last held keys: no run can still bring a smaller or
    equal one, once the runs that end at it have been read on. What lies before it is sorted
    together, which is all the memory it takes.
    """
    open_ = [r for r in map(_Run, runs) if r.held is not None]
    while open_:
        frontier = min(r.last() for r in open_)
        for r in open_:
            while r.last() == frontier and r.more():
                pass
        # a run that still ends at the frontier is at its end; all others hold rows beyond it
        part = pa.concat_tables([r.taken(frontier) for r in open_])
        open_ = [r for r in open_ if r.held.num_rows or r.more()]
        yield _lexsorted(part)


def _versions(tables: Iterator[pa.Table], entity: pa.DataType, time: pa.DataType, payload: pa.DataType) -> Iterator[pa.Table]:
    """entity, valid_from, valid_to, payload of rows in order; only the open version is carried on."""
    open_: dict | None = None

    def table(e, f, t, p) -> pa.Table:
        return pa.table({"entity": e, "valid_from": f, "valid_to": t, "payload": p})

    for t in tables:
        e, at = t["entity"].to_numpy(), t["time"].to_numpy()
        last = np.r_[(e[1:] != e[:-1]) | (at[1:] != at[:-1]), True]  # of an entity and time the row loaded last
        t = t.filter(pa.array(last))
        if open_ is not None:
            head = pa.table({n: pa.array([open_[n]], t.schema.field(n).type) for n in COLUMNS})
            t = pa.concat_tables([head, t.select(head.column_names)])
        e = t["entity"].to_numpy()
        codes = t["payload"].combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.r_[True, (e[1:] != e[:-1]) | (codes[1:] != codes[:-1])]
        t = t.filter(pa.array(starts)).combine_chunks()
        e, n = e[starts], t.num_rows
        open_ = {name: t[name][n - 1].as_py() for name in COLUMNS}
        if n > 1:
            same = e[1:] == e[:-1]
            to = t["time"].slice(1).combine_chunks()
            to = pc.if_else(pa.array(same), to, pa.scalar(None, to.type))
            yield table(t["entity"].slice(0, n - 1), t["time"].slice(0, n - 1), to, t["payload"].slice(0, n - 1))
    if open_ is not None:
        yield table(pa.array([open_["entity"]], entity), pa.array([open_["time"]], time), pa.array([None], time), pa.array([open_["payload"]], payload))


class RunStore:
    """Sorted runs of observations (entity, time, loaded, payload), bucketed by entity, under a path that all executors share.

    buckets bounds the tasks of a merge and is fixed for the life of a store. A run whose
    writer was lost has no mark of completeness and is not read.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.kinds: dict[str, str] = {}

    def add(self, observations: DataFrame) -> None:
        """One more run. observations: entity, time, loaded, payload, and optionally `run`, a small int, to write several runs in one pass.

        Rows with a null entity, time or payload do not count. Repeats of an entity and time are
        reduced to the row loaded last before the exchange, so a hot entity leaves one row a
        task and time. All runs of a store have the same types.
        """
        rows = observations if "run" in observations.columns else observations.withColumn("run", F.lit(0))
        rows = rows.where("entity IS NOT NULL AND time IS NOT NULL AND payload IS NOT NULL")
        self.kinds = dict(rows.select(*COLUMNS).dtypes)
        bucket = F.pmod(F.xxhash64("entity"), F.lit(self.buckets)).cast("int")
        last = rows.groupBy("run", bucket.alias("bucket"), "entity", "time").agg(F.max(F.struct("loaded", "payload")).alias("_last"))
        last = last.select("run", "bucket", "entity", "time", "_last.loaded", "_last.payload").select("run", "bucket", *[_stored(c, self.kinds[c]) for c in COLUMNS])
        sorted_ = last.repartition(self.buckets, "bucket").sortWithinPartitions("run", "bucket", "entity", "time")
        sorted_.write.option("maxRecordsPerFile", 0).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").partitionBy("run", "bucket").parquet(f"{self.path}/{uuid.uuid4().hex}")

    def versions(self) -> DataFrame:
        """entity, valid_from, valid_to, payload, by a k-way merge of the runs of each bucket; one task a bucket, no exchange."""
        fs, root = _file_system(self.path)
        added = [i.path for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if i.type == pafs.FileType.Directory]
        added = [p for p in sorted(added) if fs.get_file_info(f"{p}/_SUCCESS").type == pafs.FileType.File]
        path, kinds = self.path, {c: "bigint" if k.startswith("timestamp") else k for c, k in self.kinds.items()}
        schema = f"entity {kinds['entity']}, valid_from {kinds['time']}, valid_to {kinds['time']}, payload {kinds['payload']}"
        arrow = to_arrow_schema(_parse_datatype_string(schema))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, _ = _file_system(path)
            for b in batches:
                for bucket in b["id"].to_pylist():
                    yield from _merge_bucket(fs, _files(fs, added, bucket), arrow)

        out = self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(run, schema)
        back = lambda c, kind: F.timestamp_micros(c).cast(kind).alias(c) if kind.startswith("timestamp") else F.col(c)
        return out.select(back("entity", self.kinds["entity"]), back("valid_from", self.kinds["time"]), back("valid_to", self.kinds["time"]), back("payload", self.kinds["payload"]))


def _files(fs: pafs.FileSystem, added: list[str], bucket: int) -> list[str]:
    """The files of a bucket in all runs; each is sorted."""
    out = []
    for folder in added:
        runs = [i.path for i in fs.get_file_info(pafs.FileSelector(folder)) if i.type == pafs.FileType.Directory]
        for r in runs:
            found = fs.get_file_info(pafs.FileSelector(f"{r}/bucket={bucket}", allow_not_found=True))
            out += [i.path for i in found if i.path.endswith(".parquet")]
    return sorted(out)


def _merge_bucket(fs: pafs.FileSystem, names: list[str], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    size = max(256, min(BATCH, AHEAD // max(1, len(names))))

    def batches(name: str) -> Iterator[pa.RecordBatch]:
        with fs.open_input_file(name) as f:
            yield from pq.ParquetFile(f).iter_batches(size, columns=COLUMNS)

    held: list[pa.Table] = []
    rows = 0
    for t in _versions(merged([batches(n) for n in names]), arrow.field("entity").type, arrow.field("valid_from").type, arrow.field("payload").type):
        held.append(t.cast(arrow))
        rows += t.num_rows
        if rows >= OUT_ROWS:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def entity_versions(snapshots: DataFrame | list[DataFrame], key: str, time: str, payload: Column, loaded: str, run: Column | None = None, buckets: int | None = None) -> DataFrame:
    """(key, valid_from, valid_to, payload): a new version wherever the payload differs from the one before.

    snapshots: one table or several; each becomes a run of its own, and with `run` (a small int)
    a table gives as many runs as that has values. They are written as sorted runs and merged
    (see RunStore). A caller that keeps a RunStore adds only the new snapshot.

    Rows with a null key, time or payload do not count. Of rows for one entity and time the
    last loaded counts, of equally late ones the larger payload; a null `loaded` is earliest.
    valid_to is the start of the next version, null for the last.
    """
    parts = snapshots if isinstance(snapshots, list) else [snapshots]
    rows = [p.select(F.col(key).alias("entity"), F.col(time).alias("time"), F.col(loaded).alias("loaded"), payload.alias("payload"), (F.lit(i) if run is None else run).cast("int").alias("run")) for i, p in enumerate(parts)]
    store = RunStore(parts[0].sparkSession, f"{checkpoint_folder(parts[0].sparkSession)}/runs-{uuid.uuid4().hex}", buckets)
    store.add(reduce(DataFrame.unionByName, rows))
    return store.versions().withColumnRenamed("entity", key)
