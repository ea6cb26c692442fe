"""Token totals by source, language and tokenizer version, kept up to date by deltas.

A batch of changes is signed rows: an insert adds a document and its tokens, a delete takes
them away, a revised count is the difference. A batch is summed before it is stored, and it
counts from the moment its commit file is there. The file is moved into place, under the
batch's name, by a rename that fails if the name is taken: a batch counts once, however
often it is sent, and whoever sends it at the same time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
TOTALS = ["documents", "tokens"]

# Tokenizer versions that are patterns.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]",
}


def pattern_count(text: Column, tokenizer: str) -> Column:
    """Tokens of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(PATTERNS[tokenizer])), F.lit(0)).cast("long")


def bpe_counter(file: str, pattern: str) -> Callable[[Column], Column]:
    """A count of byte-pair tokens with a public vocabulary: a ``tiktoken`` rank file on
    every executor, and its splitting pattern."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(file, pattern)
        return texts.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0).astype("int64")

    return count


_encodings: dict = {}


def _encoding(file: str, pattern: str):
    """Read once per worker."""
    if file not in _encodings:
        import base64

        import tiktoken

        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[file] = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[file]


# -- changes -----------------------------------------------------------------------


def _signed(rows: DataFrame, documents: int, tokens: Column) -> DataFrame:
    return rows.select(
        *KEYS, F.lit(documents).cast("long").alias("documents"), tokens.cast("long").alias("tokens")
    )


def inserts(rows: DataFrame) -> DataFrame:
    """Of (source, lang, tokenizer, tokens)."""
    return _signed(rows, 1, F.col("tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Of (source, lang, tokenizer, tokens), the tokens as they were counted before."""
    return _signed(rows, -1, -F.col("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Of (source, lang, tokenizer, old_tokens, tokens). A document that changes its source,
    language or tokenizer is a delete and an insert."""
    return _signed(rows, 0, F.col("tokens") - F.col("old_tokens"))


def summed(deltas: DataFrame) -> DataFrame:
    """Totals per key, without keys of which nothing is left. Null tokens count as none."""
    totals = deltas.groupBy(*KEYS).agg(*[
        F.sum(F.coalesce(t, F.lit(0))).cast("long").alias(t) for t in TOTALS
    ])
    return totals.where(" or ".join(f"{t} != 0" for t in TOTALS))


# -- the table ---------------------------------------------------------------------


class Rollup:
    """The totals in a folder: ``data/`` has a folder per stored sum, ``commits/`` a file per
    batch that names its sum, ``bases/`` a file per compaction with the batches it covers."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        for name in ("data", "commits", "bases"):
            self._fs().mkdirs(self._path(name))

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)

    def _publish(self, kind: str, name: str, content: dict) -> bool:
        """Puts a file in place at once; False if the name is taken."""
        draft = self._path("data", f"_{uuid.uuid4().hex}.json")
        out = self._fs().create(draft, False)
        out.write(json.dumps(content).encode())
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(
            self._jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        try:
            files.rename(draft, self._path(kind, name), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            self._fs().delete(draft, False)
            return False
        return True

    def _read(self, kind: str) -> dict[str, dict]:
        """{name: content} of the files of a kind: one per batch since the last compaction, or
        one per compaction."""
        found = {}
        for status in self._fs().listStatus(self._path(kind)):
            name = status.getPath().getName()
            if not name.startswith((".", "_")):
                stream = self._fs().open(status.getPath())
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                found[name] = json.loads(text)
        return found

    def _state(self) -> tuple[dict | None, dict[str, dict]]:
        bases = self._read("bases")
        base = bases[max(bases)] if bases else None
        return base, self._read("commits")

    def committed(self, batch: str) -> bool:
        return self._fs().exists(self._path("commits", batch))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits the batch; False, and nothing changes, if it was committed before.

        A batch that breaks off before its commit leaves a folder that nothing reads.
        """
        if not batch or "/" in batch or batch[0] in "._":
            raise ValueError(f"not a batch name: {batch!r}")
        if self.committed(batch):
            return False
        data = f"{batch}-{uuid.uuid4().hex}"
        summed(changes).write.parquet(f"{self.folder}/data/{data}")
        return self._publish("commits", batch, {"data": data})

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens), keys with nothing left out."""
        return self._sum(*self._state())

    def _sum(self, base: dict | None, commits: dict[str, dict]) -> DataFrame:
        """The totals of one state of the folder."""
        covered = set(base["batches"]) if base else set()
        parts = [base["data"]] if base else []
        parts += [c["data"] for name, c in sorted(commits.items()) if name not in covered]
        if not parts:
            return self.spark.createDataFrame(
                [], ", ".join([f"{k} string" for k in KEYS] + [f"{t} long" for t in TOTALS])
            )
        return summed(self.spark.read.parquet(*[f"{self.folder}/data/{p}" for p in parts]))

    def compact(self) -> None:
        """Stores the present totals as one sum. Commit files stay, so that a batch sent again
        is still known; only the sums they name are read no more.

        Summed is the state that the sum names: a batch committed meanwhile stays beside it. Of
        two compactions at once the one that is published last is left without effect.
        """
        base, commits = self._state()
        data = f"base-{uuid.uuid4().hex}"
        self._sum(base, commits).write.parquet(f"{self.folder}/data/{data}")
        number = f"{len(self._read('bases')):08d}"
        self._publish("bases", number, {"data": data, "batches": sorted(commits)})
