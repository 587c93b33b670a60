"""A connector for search documents as a Python data source.

``df.write.format("doc_store").mode("append").save(root)`` and, for streams,
``writeStream.format("doc_store")``. A task sends its documents in bulks of
``bulk`` (1,000 unless given) to part files of its own attempt; the driver's
commit then writes one manifest that names the parts of the attempts that
won, and only they exist for readers. A task that is run again leaves a part
that no manifest names; an aborted write removes its parts. A manifest of a
stream is named by its batch, so a batch that is committed again replaces
itself. Reading takes the newest document of each ``_id``: to publish a
document again is to replace it.

Files are reached through pyarrow's file systems, by the URI of the root.
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from trafficlens.operators.documents import DOC_SCHEMA

# Executors need pyarrow only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BULK = 1000
NAME = "doc_store"


def _file_system(root: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


@dataclass
class Part(WriterCommitMessage):
    path: str
    rows: int
    bulks: int


class _Writer:
    """Parts and manifests under a root; what batch and stream writers share."""

    def __init__(self, root: str, bulk: int):
        self.root, self.bulk, self.job = root.rstrip("/"), bulk, uuid.uuid4().hex[:12]

    def write(self, rows) -> Part:
        context = TaskContext.get()
        name = f"parts/{self.job}/part-{context.partitionId():05d}-{context.taskAttemptId()}.json"
        system, base = _file_system(self.root)
        path, held, n, bulks = f"{base}/{name}", [], 0, 0
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as out:
            def send():
                out.write("".join(held).encode())
                held.clear()

            for row in rows:
                held.append(json.dumps(row.asDict(), default=str, ensure_ascii=False) + "\n")
                n += 1
                if len(held) == self.bulk:
                    send()
                    bulks += 1
            if held:
                send()
                bulks += 1
        return Part(name, n, bulks)

    def _manifest(self, name: str, order: int, messages) -> None:
        system, base = _file_system(self.root)
        parts = [{"path": m.path, "rows": m.rows} for m in messages if m is not None]
        system.create_dir(f"{base}/manifests", recursive=True)
        tmp = f"{base}/manifests/_{name}-{uuid.uuid4().hex[:8]}"
        with system.open_output_stream(tmp) as out:
            out.write(json.dumps({"order": order, "parts": parts}).encode())
        system.move(tmp, f"{base}/manifests/{name}.json")  # readers see it whole or not at all

    def _remove(self, messages) -> None:
        system, base = _file_system(self.root)
        for m in messages:
            if m is not None:
                system.delete_file(f"{base}/{m.path}")


class BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages) -> None:
        self._manifest(f"job-{self.job}", _next(self.root), messages)

    def abort(self, messages) -> None:
        self._remove(messages)


class StreamWriter(_Writer, DataSourceStreamWriter):
    def __init__(self, root: str, bulk: int, query: str):
        super().__init__(root, bulk)
        self.query = query

    def commit(self, messages, batchId: int) -> None:  # noqa: N803  Spark's name
        self._manifest(f"stream-{self.query}-{batchId:012d}", _next(self.root), messages)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self._remove(messages)


def manifests(root: str) -> list[dict]:
    """The committed manifests, oldest first."""
    from pyarrow import fs
    system, base = _file_system(root.rstrip("/"))
    found = system.get_file_info(fs.FileSelector(f"{base}/manifests", allow_not_found=True))
    out = []
    for info in found:
        if info.base_name.endswith(".json") and not info.base_name.startswith("_"):
            with system.open_input_stream(info.path) as f:
                out.append(json.loads(f.read().decode()))
    return sorted(out, key=lambda m: m["order"])


def _next(root: str) -> int:
    return max((m["order"] for m in manifests(root)), default=0) + 1


class DocStore(DataSource):
    """Options: path (the root), bulk, query (the name of a stream)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _root(self) -> tuple[str, int]:
        if not self.options.get("path"):
            raise ValueError("the store needs a path")
        return self.options["path"], int(self.options.get("bulk", BULK))

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("documents are replaced by their _id: use mode('append')")
        return BatchWriter(*self._root())

    def streamWriter(self, schema, overwrite: bool):  # noqa: N802
        return StreamWriter(*self._root(), self.options.get("query", "stream"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocStore)


def publish(docs: DataFrame, root: str, bulk: int = BULK) -> None:
    """Send documents to the store and commit them together."""
    register(docs.sparkSession)
    docs.select(*DOC_SCHEMA.fieldNames()).write.format(NAME).option("bulk", bulk).mode("append").save(root)


def read_docs(spark: SparkSession, root: str) -> DataFrame:
    """The newest document of every ``_id``. Documents of one manifest that
    share an id count by their other columns, the greatest last."""
    found = manifests(root)
    order = {f"{root.rstrip('/')}/{p['path']}": m["order"] for m in found for p in m["parts"] if p["rows"]}
    if not order:
        return spark.createDataFrame([], DOC_SCHEMA)
    names = spark.createDataFrame([(k.rpartition("/parts/")[2], v) for k, v in order.items()], "part string, order bigint")
    rows = spark.read.schema(DOC_SCHEMA).json(list(order)) \
        .withColumn("part", F.substring_index(F.col("_metadata.file_path"), "/parts/", -1))
    newest = Window.partitionBy("_id").orderBy(F.desc("order"), *(F.desc(c) for c in DOC_SCHEMA.fieldNames()[1:]))
    return rows.join(names, "part").withColumn("_r", F.row_number().over(newest)).where("_r = 1").select(*DOC_SCHEMA.fieldNames())
