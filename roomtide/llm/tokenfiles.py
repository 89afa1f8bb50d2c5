"""Token counts of documents in flat, unindexed token files, by a separator scan.

``write`` encodes documents and appends them to flat files of little-endian 16-bit ids, an
end-of-document id after each; nothing else is in the files.  ``scan`` counts the tokens of every
document of such files without an index: files are cut into blocks of equal size, a task finds a
block's separators with one vectorised comparison, and a prefix scan over the blocks' summaries
(separators so far; tokens since the last one) gives every document its ordinal and joins the
parts of those that cross blocks.

Writing splits a text into words as the tokenizer file does, reads each word's ids from the
tokenizers library once and joins them, since distinct words are few beside words; words held are
bounded (``bpe.Recent``).  Files of another split and texts with characters that the splitting
package knows from a later Unicode version go to the library whole.

Files lie in the shared folder and are read by path and range, each block by itself, so one file
may be larger than any task's memory.  A file is named only by the task attempt whose output Spark
kept; files of lost attempts are never read.

Defined results: null and empty texts have no tokens but count as documents; literal separator
text inside a document is ordinary text; tokens after a file's last separator are a last,
unfinished document (``finished`` false); empty files and tables give no rows; a file with an odd
number of bytes is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomtide.llm.bpe import BLANK, UNKNOWN, Recent, char_class
from roomtide.runtime import new_folder, stage

WIDTH = 2
FILE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
# The byte-level split of tokenizer files, with white space as the library understands it.
SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N}" + BLANK + r"]+|["
                 + BLANK + r"]+(?![^" + BLANK + r"])|[" + BLANK + r"]+")


class Ids(Recent):
    """Word -> its ids as bytes; made from a tokenizer file's content, special tokens are ordinary text."""

    def __init__(self, spec: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(spec)
        split = parts["pre_tokenizer"] or {}
        self.by_word = (parts["normalizer"] is None and not parts["model"].get("dropout")
                        and {k: split.get(k) for k in SPLIT} == SPLIT and all(t["special"] for t in parts["added_tokens"]))
        self.words = regex.compile(SPLIT_PATTERN).findall
        self.unknown = regex.compile(f"[{char_class(UNKNOWN)}]").search

    def read(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def of(self, text: str) -> bytes:
        """Ids of a whole text."""
        if self.by_word and (text.isascii() or not self.unknown(text)):
            return b"".join(map(self.__getitem__, self.words(text)))
        return self.read(text)


def write(documents: DataFrame, path: str, separator: str = "<|endoftext|>") -> DataFrame:
    """Encode with the tokenizer file at ``path``; returns file, ordinal, doc_id of what was written."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    end = next(t["id"] for t in json.loads(spec)["added_tokens"] if t["content"] == separator)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast({"spec": spec})  # the vocabulary file, under 2 MB
    folder = new_folder(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        # The process's words outlive a task where Spark reuses the worker.
        if "ids" not in shared.value:
            shared.value["ids"] = Ids(shared.value["spec"])
        ids, last = shared.value["ids"], np.asarray([end], "<u2").tobytes()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, out, size, ordinal = "", None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if out is None:
                    name, size, ordinal = f"{uuid.uuid4().hex}.tokens", 0, 0
                    out = store.open_output_stream(f"{root}/{name}")
                texts = [t or "" for t in part.column("text").to_pylist()]
                encoded = b"".join([ids.of(t) + last for t in texts])
                out.write(encoded)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}"] * len(texts)),
                     pa.array(range(ordinal, ordinal + len(texts)), pa.int64()), part.column("doc_id")],
                    ["file", "ordinal", "doc_id"])
                size, ordinal = size + len(encoded), ordinal + len(texts)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()

    source = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    # Staging runs the writer once; the stored names are those of the attempts that counted.
    return stage(source.mapInArrow(run, f"file string, ordinal long, doc_id {kind}"))


def file_sizes(spark: SparkSession, folders: list[str]) -> DataFrame:
    """file, size of every file under the folders; contents are not read."""
    return spark.read.format("binaryFile").load(folders).select(
        F.col("path").alias("file"), F.col("length").alias("size"))


def scan(files: DataFrame, end: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, ordinal, n_tokens, finished of every document in the files (file, size)."""
    blocks = files.where("size > 0").select(
        "file", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {block_bytes})")).alias("block"))
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                if row["size"] % WIDTH:
                    raise ValueError(f"{row['file']}: not a whole number of {WIDTH}-byte ids")
                store, path = fs.FileSystem.from_uri(row["file"])
                with store.open_input_file(path) as file:
                    data = file.read_at(min(block_bytes, row["size"] - row["block"] * block_bytes),
                                        row["block"] * block_bytes)
                ids = np.frombuffer(data, "<u2")
                at = np.flatnonzero(ids == end)
                # Tokens before the first separator, between separators, after the last one.
                lengths = np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["block"]], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([int(lengths[0])], pa.int64()),
                     pa.array([int(lengths[-1])], pa.int64()), pa.array([lengths[1:-1].tolist()], pa.list_(pa.int64()))],
                    ["file", "block", "ends", "head", "tail", "inner"])

    found = stage(blocks.repartition(tasks, "file", "block").mapInArrow(
        run, "file string, block long, ends long, head long, tail long, inner array<long>"))
    # One narrow row per block goes through the scan: what the blocks before it carry over.
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    summary = found.select("file", "block", "ends", "head", "tail")
    scanned = (summary
               .withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
               .withColumn("run", F.count(F.when(F.col("ends") > 0, 1)).over(before)))
    # The tail after the last separator so far, plus whole blocks without one.
    opened = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("head"))
    carried = (scanned.withColumn("opened", F.lag(opened).over(in_file))
               .withColumn("carry", F.coalesce(F.sum(F.coalesce("opened", F.lit(0))).over(
                   Window.partitionBy("file", "run").orderBy("block")), F.lit(0))))
    last = Window.partitionBy("file")
    carried = carried.withColumn("last", F.max("block").over(last) == F.col("block"))
    closed = carried.where("ends > 0").select(
        "file", F.col("first").alias("ordinal"), (F.col("head") + F.col("carry")).alias("n_tokens"), F.lit(True).alias("finished"))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("head") + F.col("carry"))
    unfinished = carried.where("last").select(
        "file", (F.col("first") + F.col("ends")).alias("ordinal"), left.alias("n_tokens"), F.lit(False).alias("finished")
    ).where("n_tokens > 0")
    firsts = scanned.select("file", "block", "first")
    inner = found.where(F.size("inner") > 0).select("file", "block", "inner").join(firsts, ["file", "block"]).select(
        "file", "first", F.posexplode("inner").alias("at", "n_tokens")).select(
        "file", (F.col("first") + F.col("at") + 1).alias("ordinal"), "n_tokens", F.lit(True).alias("finished"))
    return closed.unionByName(inner).unionByName(unfinished)


def counts(documents: DataFrame, path: str, separator: str = "<|endoftext|>") -> DataFrame:
    """doc_id, n_tokens, file, ordinal: write flat files, then count by scanning them."""
    with open(path, encoding="utf-8") as file:
        end = next(t["id"] for t in json.load(file)["added_tokens"] if t["content"] == separator)
    written = write(documents, path, separator)
    names = [r[0] for r in written.select("file").distinct().limit(1).collect()]
    spark = documents.sparkSession
    if not names:
        return written.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "file", "ordinal")
    folder = names[0].rpartition("/")[0]
    listed = file_sizes(spark, [folder])
    # Only files of attempts that counted; paths compare by name, unique in the folder.
    last = F.substring_index("file", "/", -1)
    kept = written.select("file").distinct().select(last.alias("name"), F.col("file").alias("_file"))
    files = listed.withColumn("name", last).join(kept, "name").select(F.col("_file").alias("file"), "size")
    scanned = scan(files, end)
    return written.join(scanned.drop("finished"), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
