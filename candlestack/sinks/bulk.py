"""Bulk sends of keyed documents with a commit (W31).

``df.write.format("candlestack_bulk")`` sends documents (``_id``, ``_index``,
``_source``) in batches from every task through a client, as a Python data
source writer: a task's message carries its tally and the names of what it
staged, ``commit`` makes the send visible in one step, ``abort`` drops it.  A
task that runs twice stages twice, but only the attempt whose message arrives
is committed, so retries never count twice.

Documents that the client refuses are kept with the reason, never just
counted.  A client that raises refuses its whole batch, with the error's text
as the reason.

The default client is a folder that works as a keyed store: ``BulkStore``
reads the documents of committed sends, the latest send's document of each
``_id`` (so sending again changes nothing, whatever the partitions), the
refused ones, and the tallies.  Other stores plug in as a client object.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# Shipped by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "candlestack_bulk"
COLUMNS = ("_index", "_id", "_source")


class FolderClient:
    """Stages documents as Parquet files under ``root/staged/run=<run>/``: one file a
    task attempt for accepted documents and one for refused ones."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _open(self, path: str):
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(self.root)
        folder, _, _ = f"{base}/{path}".rpartition("/")
        filesystem.create_dir(folder, recursive=True)
        return filesystem, f"{base}/{path}"

    def start(self, run: str, task: str) -> None:
        self.files: dict = {}
        self.run, self.task = run, task

    def bulk(self, actions: list) -> list:
        """Stages a batch of (index, id, source); returns (position, reason) of those
        refused."""
        refused = []
        for i, (_, doc_id, source) in enumerate(actions):
            if doc_id is None:
                refused.append((i, "no _id"))
                continue
            try:
                ok = isinstance(json.loads(source or ""), dict)
            except ValueError:
                ok = False
            if not ok:
                refused.append((i, "source is not a JSON object"))
        bad = {i for i, _ in refused}
        self._append("docs", [a for i, a in enumerate(actions) if i not in bad])
        return refused

    def keep_refused(self, rows: list) -> None:
        """Stages (index, id, source, reason)."""
        self._append("refused", rows)

    def _append(self, kind: str, rows: list) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if not rows:
            return
        names = [*COLUMNS, "reason"][:len(rows[0])]
        table = pa.Table.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)
        if kind not in self.files:
            path = f"staged/{kind}/run={self.run}/{self.task}.parquet"
            filesystem, full = self._open(path)
            out = filesystem.open_output_stream(full)
            self.files[kind] = (path, pq.ParquetWriter(out, table.schema), out)
        self.files[kind][1].write_table(table)

    def finish(self) -> list:
        """Closes the files; their paths under ``root``."""
        for _, writer, out in self.files.values():
            writer.close()
            out.close()
        return [path for path, _, _ in self.files.values()]

    def commit(self, run: str, record: dict) -> None:
        filesystem, full = self._open(f"commits/{run}.json")
        with filesystem.open_output_stream(full) as f:
            f.write(json.dumps(record).encode())

    def abort(self, paths: list) -> None:
        for path in paths:
            filesystem, full = self._open(path)
            filesystem.delete_file(full)


@dataclass
class Sent(WriterCommitMessage):
    """What a task sent: {index: [written, failed]}, and the paths it staged."""

    tally: dict = field(default_factory=dict)
    paths: list = field(default_factory=list)


class BulkWriter(DataSourceWriter):
    def __init__(self, client, columns: list, run: str, batch_size: int):
        self.client, self.run, self.batch_size = client, run, batch_size
        self.places = [columns.index(c) for c in COLUMNS]

    def write(self, iterator: Iterator) -> Sent:
        from pyspark import TaskContext

        client = self.client
        # a name of its own for every attempt
        client.start(self.run, f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}")
        tally: dict = {}

        def send(batch: list) -> None:
            try:
                refused = client.bulk(batch)
            except Exception as e:  # the store's answer to the batch, kept as the reason
                refused = [(i, f"{type(e).__name__}: {e}") for i in range(len(batch))]
            client.keep_refused([(*batch[i], reason) for i, reason in refused])
            bad = {i for i, _ in refused}
            for i, (index, _, _) in enumerate(batch):
                tally.setdefault(index, [0, 0])[i in bad] += 1

        batch: list = []
        for row in iterator:
            batch.append(tuple(row[p] for p in self.places))
            if len(batch) == self.batch_size:
                send(batch)
                batch = []
        if batch:
            send(batch)
        return Sent(tally, client.finish())

    def commit(self, messages: list) -> None:
        """One record of the send: tallies by index and the paths that count."""
        tally: dict = {}
        for m in messages:
            for index, (ok, bad) in (m.tally if m else {}).items():
                total = tally.setdefault(index, [0, 0])
                total[0] += ok
                total[1] += bad
        self.client.commit(self.run, {
            "run": self.run,
            "tally": [{"target": k, "written": w, "failed": f} for k, (w, f) in tally.items()],
            "paths": [p for m in messages if m for p in m.paths]})

    def abort(self, messages: list) -> None:
        self.client.abort([p for m in messages if m for p in m.paths])


class BulkSource(DataSource):
    """Options: ``store`` (the folder of the default client), ``run`` (a name that sorts
    after those of earlier sends), ``batch_size`` (1,000)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        missing = [c for c in COLUMNS if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"documents lack {missing}")
        return BulkWriter(self.client(), schema.fieldNames(), self.options["run"],
                          int(self.options.get("batch_size", "1000")))

    def client(self):
        return FolderClient(self.options["store"])


def send(docs: DataFrame, store: str, run: str, batch_size: int = 1000,
         source: type[DataSource] = BulkSource) -> None:
    """Sends ``docs`` to ``store`` as the send ``run``.  ``source`` may be a subclass
    whose ``client()`` talks to another store."""
    docs.sparkSession.dataSource.register(source)
    (docs.select(*COLUMNS).write.format(source.name()).option("store", store)
     .option("run", run).option("batch_size", str(batch_size)).mode("append").save())


class BulkStore:
    """What committed sends left in a folder."""

    COMMIT = "run string, tally array<struct<target:string,written:long,failed:long>>," \
             " paths array<string>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> DataFrame:
        return self.spark.read.schema(self.COMMIT).json(f"{self.root}/commits")

    def tallies(self) -> DataFrame:
        """(run, target, written, failed)."""
        return self.commits().select("run", F.explode("tally").alias("t")).select("run", "t.*")

    def _staged(self, kind: str, extra: str = "") -> DataFrame:
        """Rows of the files that committed sends name; a list of a row a task attempt."""
        paths = self.commits().select(
            F.explode("paths").alias("p")).select(F.element_at(F.split("p", "/"), -1).alias("file"))
        rows = (self.spark.read.schema(f"_index string, _id string, _source string{extra},"
                                       " run string")
                .option("recursiveFileLookup", "false").parquet(f"{self.root}/staged/{kind}"))
        return (rows.withColumn("file", F.col("_metadata.file_name"))
                .join(paths, "file", "left_semi").drop("file"))

    def documents(self) -> DataFrame:
        """(_index, _id, _source): of each index and id the document of the latest send;
        of several in one send the one whose source sorts last."""
        latest = F.max(F.struct("run", "_source")).alias("latest")
        return (self._staged("docs").groupBy("_index", "_id").agg(latest)
                .select("_index", "_id", F.col("latest._source").alias("_source")))

    def refused(self) -> DataFrame:
        """(run, _index, _id, _source, reason)."""
        return self._staged("refused", ", reason string").select("run", *COLUMNS, "reason")
