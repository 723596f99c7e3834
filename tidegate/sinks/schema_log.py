"""A schema catalog that several writers may append to at once.

A commit is a small table of catalog rows and a mark with the commit's number. A writer
reads the catalog as of the last mark, computes its new rows from it, writes them where
nobody looks, and sets the next mark, which succeeds for one writer only. The others read
what was added meanwhile and compute anew. So versions of a subject are dense, and a schema
is registered under a subject once, whoever came first.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tidegate.operators.catalog import register_schemas

ROWS = "subject string, version bigint, schema_id bigint, profile string, schema_json string, fingerprint string"
DIGITS = 12


class SchemaLog:
    def __init__(self, spark: SparkSession, root: str, tries: int = 50):
        self.spark, self.root, self.tries = spark, root.rstrip("/"), tries
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.path(self.root).getFileSystem(conf)
        whole = self.files.makeQualified(self.path(self.root)).toUri()
        self.local = whole.getPath() if whole.getScheme() == "file" else None
        self.context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole, conf)
        self.no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def mark(self, number: int) -> str:
        return f"{self.root}/marks/{number:0{DIGITS}d}"

    def commits(self) -> list[str]:
        """The tables of all commits in order. Marks are dense, as each was set by a writer
        that had seen the one before."""
        folder = self.path(f"{self.root}/marks")
        if not self.files.exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in self.files.listStatus(folder))
        return [self.table_of(int(n)) for n in names if len(n) == DIGITS and n.isdigit()]

    def table_of(self, number: int) -> str:
        stream = self.files.open(self.path(self.mark(number)))
        try:
            return f"{self.root}/rows/{bytes(stream.readAllBytes()).decode()}"
        finally:
            stream.close()

    def read(self, commits: list[str] | None = None) -> DataFrame:
        """The catalog, as of now or of the given commits."""
        commits = self.commits() if commits is None else commits
        if not commits:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*commits)

    def claim(self, number: int, name: str) -> bool:
        """Set mark ``number``; False where another writer has."""
        self.files.mkdirs(self.path(f"{self.root}/marks"))
        made, mark = f"{self.root}/marks/{uuid.uuid4().hex}.new", self.mark(number)
        out = self.files.create(self.path(made), False)
        out.write(name.encode())
        out.close()
        try:
            if self.local is not None:  # a link, unlike a rename, never replaces a file
                folder = os.path.join(self.local, "marks")
                os.link(os.path.join(folder, os.path.basename(made)), os.path.join(folder, os.path.basename(mark)))
            else:
                self.context.rename(self.path(made), self.path(mark), self.no_options)
                return True
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        finally:
            if self.files.exists(self.path(made)):
                self.files.delete(self.path(made), False)
        return True

    def register(self, candidates: DataFrame) -> DataFrame:
        """Append (subject, profile, schema_json) rows that are not there yet; returns the
        catalog rows this call added."""
        for _ in range(self.tries):
            seen = self.commits()
            name = uuid.uuid4().hex
            table = f"{self.root}/rows/{name}"
            register_schemas(self.read(seen), candidates).select(*[c.split()[0] for c in ROWS.split(", ")]).write.parquet(table)
            added = self.spark.read.schema(ROWS).parquet(table)
            if added.isEmpty() or self.claim(len(seen) + 1, name):
                return added
            self.files.delete(self.path(table), True)
        raise RuntimeError(f"other writers were faster {self.tries} times")
