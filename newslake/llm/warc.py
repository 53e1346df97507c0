"""Web archives: pages written as WARC records, and records found again by their chain.

The bytes ``WARC/1.1`` also occur inside payloads, so where they stand is no proof of a
record.  Every task reads one block of a file, cut at these bytes, and gives for each
candidate where its header says the next record begins.  Inside a block the successors
are followed at once, to the first one beyond the block.  What is left is one step per
block, and pointer jumping from the start of each file finds in few rounds which of
them are reached.  Records are the candidates on that way; all other pieces are parts of
the payload they lie in, also where it goes over several blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslake.llm.common import pick, remove, write, written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Equal payloads of at least so many bytes are written once.
SHARED_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = (
    "id string, type string, refers string, url string, stated_digest string, stated_bytes long, "
    "bytes long, digest string, payload binary"
)


def _urn(key: Column) -> Column:
    """An id as an address; null has none of its own."""
    return F.concat(F.lit("<urn:page"), F.coalesce(F.concat(F.lit(":"), F.url_encode(key.cast("string"))), F.lit("")), F.lit(">"))


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def records_of(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC record of every row, without its two line ends.

    The payload is the html in UTF-8, null as empty.  Of rows with equal payloads of at
    least ``SHARED_BYTES`` bytes that with the smallest id is a response, the others are
    revisits of it, which hold its HTTP header only; smaller payloads are all responses.
    Rows that repeat an id and its payload share a record id: where it is the smallest,
    all of them are responses.  Null ids come after all others.
    """
    rows = pick(df, id=id_col, url=url_col, html=html_col).withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    large = rows.filter(F.octet_length("html") >= SHARED_BYTES)
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    # Written, so that the join has shuffles of its own and a digest with very many rows is split.
    firsts = written(first.filter("copies > 1 AND first IS NOT NULL").drop("copies"), "warc-firsts")
    known = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.octet_length("html").cast("string")),
        F.lit("\r\n"),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    escaped = F.coalesce("url", F.lit(""))
    for char, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    header = [
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("id"))),
        _line("WARC-Date", date),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", escaped)).otherwise(""),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _urn(F.col("first"))), _line("WARC-Profile", PROFILE))).otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Content-Type", "application/http;msgtype=response"),
        _line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    ]
    return known.withColumn("block", block).select(F.concat(*header, F.col("block")).alias("value"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write records to a new folder of WARC files, one per task."""
    records.write.option("lineSep", END).text(path)


def header_of(segment: bytes) -> tuple[dict[str, str], int] | None:
    """The named fields of a record behind its first line, and where its content begins."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        return None
    return fields, end + 4


def parse(segment: bytes, payloads: bool) -> tuple:
    """What a whole record says, in the order of ``_FIELDS``."""
    fields, start = header_of(segment)
    content = segment[start : start + int(fields["content-length"])]
    payload, stated = content, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = content.partition(b"\r\n\r\n")
        said = re.search(rb"(?i)\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r?(?:\n|\Z)", http)
        stated = int(said[1]) if said else None
    digest = fields.get("warc-payload-digest", "")
    return (
        fields.get("warc-record-id"),
        fields.get("warc-type"),
        fields.get("warc-refers-to"),
        fields.get("warc-target-uri"),
        digest.removeprefix("sha256:") if digest.startswith("sha256:") else None,
        stated,
        len(payload),
        hashlib.sha256(payload).hexdigest(),
        payload if payloads else None,
    )


_NOTHING = (None,) * 9
_KINDS = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string(), pa.binary()]
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _arrays(parsed: list[tuple]) -> list[pa.Array]:
    return [pa.array(list(c), k) for c, k in zip(zip(*parsed, strict=True), _KINDS, strict=True)]


def _segments(spark: SparkSession, path: str, payloads: bool, every: bool = False) -> DataFrame:
    """The pieces between magic bytes, by file, block and place in the block.

    ``at`` is where the piece's magic begins and ``next`` where the record after it would,
    both from where the first piece of the block begins; ``next`` is null where the piece
    begins with no header.  A piece that is one whole record, if it is one, is parsed at
    once; ``raw`` is kept of the others, or of ``every`` piece.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    pieces = lines.select("_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = None, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                files, blocks, values = (part.column(i).to_pylist() for i in range(3))
                ats, sizes, nexts, parsed, raws = [], [], [], [], []
                for file, block, value in zip(files, blocks, values, strict=True):
                    opening = (file, block) != place
                    if opening:
                        place, at = (file, block), 0
                    header = None if opening and block == 0 else header_of(value)
                    begin = at - len(MAGIC)
                    at += len(value) + len(MAGIC)
                    ends = None
                    if header is not None:
                        ends = begin + len(MAGIC) + header[1] + int(header[0]["content-length"]) + len(END)
                    whole = ends is not None and ends == at - len(MAGIC)
                    ats.append(begin)
                    sizes.append(len(value) + len(MAGIC))
                    nexts.append(ends)
                    parsed.append(parse(value, payloads) if whole else _NOTHING)
                    raws.append(None if whole and not every else value)
                own = [pa.array(c, pa.int64()) for c in (ats, sizes, nexts)]
                columns = [part.column(0), part.column(1), *own, pa.array(raws, pa.binary()), *_arrays(parsed)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "block", "at", "size", "next", "raw", *_NAMES])

    return pieces.mapInArrow(run, f"file string, block long, at long, size long, next long, raw binary, {_FIELDS}")


def _exits(block: pd.DataFrame) -> pd.DataFrame:
    """Where the successors of every candidate of one block leave it; null if they end inside."""
    block = block.sort_values("at")
    last, exits = int(block["at"].iloc[-1]), {}
    for at, following in zip(reversed(block["at"].tolist()), reversed(block["next"].tolist()), strict=True):
        if not pd.isna(following):
            exits[at] = int(following) if following > last else exits.get(int(following))
    whose = {"file": block["file"].iloc[0], "block": block["block"].iloc[0]}
    return pd.DataFrame({**whose, "at": list(exits), "exit": pd.array(list(exits.values()), "Int64")})


def _reached(steps: DataFrame) -> DataFrame:
    """``file, at``: the ends of steps ``(file, at, exit)`` that are reached from 0 of each file.

    Steps without an exit are reached like others, but lead nowhere.  In every round what is reached jumps, and all jumps become twice as long, so the
    rounds grow with the logarithm of the blocks in a file.
    """
    spark = steps.sparkSession
    starts = steps.filter("at = 0").select("file", "at")
    entered = steps.select("file", F.col("exit").alias("at")).union(starts).distinct()
    entries = written(steps.join(entered, ["file", "at"], "left_semi"), "warc-entries")
    goals = entries.select("file", F.col("at").alias("exit"))
    jumps = write(entries.join(goals, ["file", "exit"], "left_semi").select("file", "at", "exit"), "warc-jumps")
    reached = write(starts.distinct(), "warc-reached")
    count, before = spark.read.parquet(reached).count(), -1
    while count != before:
        now, jump = spark.read.parquet(reached), spark.read.parquet(jumps)
        further = now.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at"))
        found = write(now.union(further).distinct(), "warc-reached")
        second = jump.select("file", F.col("at").alias("exit"), F.col("exit").alias("far"))
        longer = write(jump.join(second, ["file", "exit"]).select("file", "at", F.col("far").alias("exit")), "warc-jumps")
        remove(spark, reached)
        remove(spark, jumps)
        reached, jumps, before = found, longer, count
        count = spark.read.parquet(reached).count()
    return spark.read.parquet(reached)


def _marks(block: pd.DataFrame) -> pd.DataFrame:
    """The pieces of a block that belong to records, each with the end of its record."""
    block = block.sort_values("at")
    lead, entry = block["lead"].iloc[0], block["entry"].iloc[0]
    due, ends, at_of, heads = (None if pd.isna(entry) else int(entry)), [], [], []
    open_until = -1 if pd.isna(lead) else int(lead)
    for at, following in zip(block["at"].tolist(), block["next"].tolist(), strict=True):
        head = at >= open_until
        if head:
            if at != due or pd.isna(following):
                break
            open_until = due = int(following)
        at_of.append(at)
        ends.append(open_until)
        heads.append(head)
    whose = {"file": block["file"].iloc[0], "block": block["block"].iloc[0]}
    return pd.DataFrame({**whose, "at": at_of, "ends": ends, "head": heads})


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all WARC files of a folder:
    ``id, type, refers, url, stated_digest, stated_bytes, bytes, digest, payload``.

    ``id`` and ``refers`` are those of ``records_of`` as texts, null where there is none;
    ``stated_...`` is what the record says of its whole payload, ``bytes`` and ``digest``
    (SHA-256, hex) what it holds.  Without ``payloads`` that column is null and payloads
    are only kept where magic bytes cut them into pieces.

    A file is read up to the first place where no record begins, so nothing behind a
    damaged record is taken for one; a record that the file's end cuts off is left out,
    and an empty folder gives an empty table.  Files are
    read in blocks by many tasks; the folder is not needed any more when this returns.
    """
    segments = written(_segments(spark, path, payloads), "warc-segments")
    pieces = segments.select("file", "block", "at", "size", "next")
    sizes = pieces.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = written(sizes.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "warc-blocks")
    placed = pieces.join(bases, ["file", "block"]).select(
        "file", "block", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("next")).alias("next")
    )
    # The piece before a file's first magic is no candidate, but it may hold the place before 0.
    placed = placed.filter("at >= 0")
    steps = written(
        placed.groupBy("file", "block").applyInPandas(_exits, "file string, block long, at long, exit long"), "warc-exits"
    )
    entries = _reached(steps.drop("block"))
    entered = steps.join(entries, ["file", "at"])
    per_block = bases.join(entered.withColumnRenamed("at", "entry"), ["file", "block"], "left")
    lead = F.last("exit", ignorenulls=True).over(before)
    known = per_block.select("file", "block", "base", "entry", lead.alias("lead"))
    asked = placed.join(known, ["file", "block"]).groupBy("file", "block")
    marks = asked.applyInPandas(_marks, "file string, block long, at long, ends long, head boolean")
    own = marks.join(bases, ["file", "block"]).select("file", "block", (F.col("at") - F.col("base")).alias("at"), "ends", "head")

    found = segments.join(written(own, "warc-marks"), ["file", "block", "at"])
    whole = found.filter("head AND raw IS NULL").select(*_NAMES)
    parts = found.filter("raw IS NOT NULL").select("file", "ends", "block", "at", "raw")
    within = written(found.filter("NOT head AND raw IS NULL").select("file", "ends", "block", "at"), "warc-within")
    if not within.isEmpty():  # whole records inside payloads: their bytes are read once more
        every = _segments(spark, path, False, every=True).select("file", "block", "at", "raw")
        parts = parts.unionByName(written(every.join(within, ["file", "block", "at"]), "warc-again"))
    order = F.array_sort(F.collect_list(F.struct("block", "at", "raw")))
    cut = parts.groupBy("file", "ends").agg(order.alias("parts"))
    joined = cut.select(F.transform("parts", lambda x: x["raw"]).alias("parts"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                record = MAGIC.encode().join(batch.column(0).slice(i, 1).to_pylist()[0])
                fields, start = header_of(record)
                if len(record) < start + int(fields["content-length"]):
                    continue  # the file ends inside
                yield pa.RecordBatch.from_arrays(_arrays([parse(record, payloads)]), _NAMES)

    both = whole.unionByName(joined.mapInArrow(put_together, _FIELDS))
    plain = {c: F.url_decode(F.nullif(F.regexp_extract(c, "^<urn:page:([^>]*)>$", 1), F.lit(""))) for c in ("id", "refers")}
    return both.withColumns(plain)
