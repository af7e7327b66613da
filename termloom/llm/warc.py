"""WARC archives: writing with revisit records, reading with boundary-chain verification."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termloom.llm.staging import Stage, stage
from termloom.operators.joins import same_value

_END = "\r\n\r\n"
#: What the scan cuts files at: no proper end of it is also a start of it, so a text reader
#: finds every occurrence, and no header line can begin like this.
_MAGIC = "\nWARC/1."
_CUT = len(_MAGIC)

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: 20 bits become 4 characters."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS32, _BASE32)


def resolve_revisits(records: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``(id, uri, payload)`` with ``digest`` and ``refers_to``.

    Of records whose payloads are equal and have at least ``min_bytes``, the one with the largest
    id is the response (all of them, if several rows have that id); ``refers_to`` is its id for
    the others, else null. Records with a null id refer to one with an id if there is one.
    """
    digested = records.withColumn("digest", base32_sha1(F.col("payload")))
    groups = digested.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
    several = groups.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("first")).where("n > 1")
    # Written first: a small table of copies is then broadcast by its size and no payload is
    # shuffled; a large one is joined on a key whose hot partitions can be split.
    copied = stage(several.select(F.col("digest").alias("of"), "first"))
    joined = digested.join(copied, same_value(F.col("digest"), F.col("of")), "left")
    other = ~F.col("first").eqNullSafe(F.col("id")) & F.col("first").isNotNull()
    return joined.select("id", "uri", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_warc(
    records: DataFrame,
    path: str,
    *,
    record_id: str = "id",
    uri: str = "uri",
    payload: str = "payload",
    date: str = "1970-01-01T00:00:00Z",
    min_bytes: int = 0,
    records_per_file: int = 0,
) -> None:
    """Write every row as one WARC/1.1 record, uncompressed, one archive a task.

    Equal payloads are stored once: the others are ``revisit`` records with the digest, the
    length of the full payload and the id of the response, see ``resolve_revisits``. Null
    payloads are empty, null ids and addresses are left out. Line ends in an address are
    percent-encoded. Written by Spark's own text sink, whose line separator is the end of a
    record, so a failed task leaves nothing behind and any store will do.
    """
    rows = records.select(
        F.col(record_id).alias("id"),
        F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = resolve_revisits(rows, min_bytes=min_bytes)
    revisit = F.col("refers_to").isNotNull()
    address = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    urn = lambda c: F.concat(F.lit("<urn:record:"), F.col(c).cast("string"), F.lit(">"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    size = F.octet_length("payload")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.coalesce(line("WARC-Record-ID", urn("id")), F.lit("")),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", profile), line("WARC-Refers-To", urn("refers_to")),
                                 line("WARC-Payload-Length", size.cast("string")))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))),
        F.lit(_END),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    out = rows.select(F.concat(header, body).alias("value"))
    out.write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).text(path)


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row for each start of a file and each place where the magic stands at a line start.

    ``at`` orders the rows of a split. The header of a true record is always whole, as no line
    of it begins with the magic; what follows it may go on in later rows.
    """
    scan = spark.read.option("lineSep", _MAGIC).text(path)
    rows = scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.octet_length("value").cast("bigint").alias("bytes"),
        F.substring_index("value", _END, 1).alias("head"),
        F.col("value").cast("binary").alias("value"),
    )
    # The header's last line end belongs to the separator if the payload begins with the magic.
    cut = F.endswith("head", F.lit("\r\n\r"))
    rows = rows.withColumn("head", F.when(cut, F.expr("left(head, length(head) - 3)")).otherwise(F.col("head")))
    length = F.regexp_extract("head", r"(?i)\r\nContent-Length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", 1)
    return rows.withColumns(
        {
            "head_bytes": F.octet_length("head").cast("bigint"),
            "body_bytes": F.when(length != "", length.cast("bigint")),
        }
    ).withColumn("sha1", base32_sha1(_block(F.col("value"))))


def _block(value: Column) -> Column:
    """The payload in the bytes after a magic; empty if the length is unknown."""
    start = (F.col("head_bytes") + len(_END) + 1).cast("int")
    return F.coalesce(F.substring(value, start, F.col("body_bytes").cast("int")), F.lit(b""))


def _split_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Places, successors and the exits of one split's candidates, counted from its start."""
    rows = rows.sort_values("at", ignore_index=True)
    place = (rows["bytes"] + _CUT).cumsum().shift(fill_value=0)
    # From the place after one magic to that after the next: header, end, block, end, magic.
    following = place + rows["head_bytes"] + rows["body_bytes"].astype("Int64") + 2 * len(_END) + _CUT - 1
    known = {p: i for i, p in enumerate(place.tolist())}
    exits = [None] * len(rows)
    for i in range(len(rows) - 1, -1, -1):
        if following[i] is not pd.NA:
            inside = known.get(following[i])
            exits[i] = int(following[i]) if inside is None else exits[inside]
    return pd.DataFrame(
        {
            "file": rows["file"],
            "split": rows["split"],
            "at": rows["at"],
            "place": place,
            "following": following,
            "leaves": pd.array(exits, dtype="Int64"),
            "total": int((rows["bytes"] + _CUT).sum()),
            "named": rows["named"],
        }
    )


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one split on the chain from the place where it is entered."""
    following = dict(zip(rows["place"], rows["following"], strict=True))
    on, place = set(), int(rows["entry"].iloc[0])
    while place in following:
        on.add(place)
        if pd.isna(following[place]):
            break
        place = int(following[place])
    return rows[rows["place"].isin(on)][["file", "at", "place", "following"]]


_LINK = "file string, split bigint, at bigint, place bigint, following bigint, leaves bigint, total bigint, named boolean"


def chain(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(file, at, place, following, intact)`` of the candidates that a file's start leads to,
    and ``(file, at, place)`` of all candidates.

    Each split first follows its own records, which leaves one pointer out of the split for each
    candidate. Pointer jumping then runs from the files' starts over these pointers alone, so it
    takes about as many rounds as the logarithm of the splits of the longest file. ``intact``
    tells that the record ends where a record or the end of the file follows.
    """
    named = F.startswith("head", F.lit(_MAGIC[1:])).alias("named")
    narrow = candidates.select("file", "split", "at", "bytes", "head_bytes", "body_bytes", named)
    local = Stage(narrow.groupBy("file", "split").applyInPandas(_split_links, _LINK))
    splits = local.df.groupBy("file", "split").agg(F.first("total").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    bases = splits.select(
        "file",
        "split",
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
        # The place that a last record's successor would have.
        (F.sum("total").over(whole) - 1).alias("end"),
    )
    placed = local.df.join(bases, ["file", "split"])
    for column in ("place", "following", "leaves"):
        placed = placed.withColumn(column, F.col(column) + F.col("base"))
    nodes = stage(placed.drop("total", "base"))
    local.drop()

    # Entries of splits: a file's start, and wherever a pointer leaves another split to.
    starts = nodes.where("place = 0 AND named").select("file", "place")
    targets = starts.unionByName(nodes.where("leaves < end").select("file", F.col("leaves").alias("place"))).distinct()
    jumps = Stage(nodes.join(targets, ["file", "place"]).select("file", "place", "leaves"))
    reached = Stage(starts)
    while True:
        step = reached.df.join(jumps.df, ["file", "place"]).where("leaves IS NOT NULL")
        more = Stage(reached.df.unionByName(step.select("file", F.col("leaves").alias("place"))).distinct())
        grown = more.df.count() > reached.df.count()
        reached.drop()
        reached = more
        if not grown:
            break
        then = jumps.df.select("file", F.col("place").alias("leaves"), F.col("leaves").alias("next"))
        doubled = Stage(jumps.df.join(then, ["file", "leaves"], "left").select("file", "place", F.coalesce("next", "leaves").alias("leaves")))
        jumps.drop()
        jumps = doubled
    entries = nodes.join(reached.df, ["file", "place"]).select("file", "split", F.col("place").alias("entry"))
    walked = nodes.join(entries, ["file", "split"]).groupBy("file", "split").applyInPandas(
        _walk, "file string, at bigint, place bigint, following bigint"
    )
    known = nodes.select("file", F.col("place").alias("following")).unionByName(
        nodes.select("file", F.col("end").alias("following")).distinct()
    )
    known = known.withColumn("__known", F.lit(True))
    # As many rows as records, and no key more than once: always by sort-merge.
    records = walked.join(known.hint("merge"), ["file", "following"], "left").select(
        "file", "at", "place", "following", F.coalesce("__known", F.lit(False)).alias("intact")
    )
    return records, nodes.select("file", "at", "place")


#: Spans are cut at multiples of so many bytes to find the rows inside them by an equality join.
_BLOCK = 1 << 16


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of uncompressed archives below ``path``, one row each.

    Columns: ``file``, ``offset``, ``record_type``, ``record_id``, ``uri``, ``refers_to``,
    ``digest`` (as in the header, without ``sha1:``), ``payload_bytes`` (of the full payload
    also for revisits), ``payload``, ``payload_sha1`` (of what was read, in base 32), ``intact``
    (false if no record or end of file follows). Leave out ``payload`` if the digest is enough:
    payloads are then not shuffled.

    Every place where a line begins with the magic is a candidate with a successor, which its
    Content-Length gives. Only candidates that the start of the file leads to are records (see
    ``chain``); the others are part of a payload and are put back into it. A file without a
    record at its start gives no rows; one cut short gives the records up to the cut.
    """
    table = stage(_candidates(spark, path))
    records, candidates = chain(table)
    # Spark would take the size of the compressed file for that of the rows.
    whole = table.join(stage(records).hint("merge"), ["file", "at"])
    # A block that its row does not hold whole goes on in the rows after it.
    after = F.col("bytes") - F.col("head_bytes") - len(_END)
    spans = stage(whole.where(after < F.col("body_bytes")).select("file", "at", "place", "following"))
    # Mostly few rows, so that they are broadcast by their size and no payload is shuffled.
    gathered = stage(_gather(table, candidates, spans))
    whole = whole.join(gathered.hint("merge"), ["file", "at"], "left")
    payload = _block(F.coalesce("gathered", "value"))
    sha1 = F.when(F.col("gathered").isNull(), F.col("sha1")).otherwise(base32_sha1(_block(F.col("gathered"))))
    size = F.when(F.col("gathered").isNull() & (after < F.col("body_bytes")), after).otherwise(F.col("body_bytes"))
    header = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    bare = lambda name: F.nullif(F.regexp_extract(header(name), r"^<urn:record:(.*)>$", 1), F.lit(""))
    full_bytes = F.coalesce(header("WARC-Payload-Length").cast("bigint"), F.greatest(size, F.lit(0)))
    return whole.select(
        "file",
        F.greatest(F.col("place") - (_CUT - 1), F.lit(0)).alias("offset"),
        header("WARC-Type").alias("record_type"),
        bare("WARC-Record-ID").alias("record_id"),
        header("WARC-Target-URI").alias("uri"),
        bare("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        full_bytes.alias("payload_bytes"),
        sha1.alias("payload_sha1"),
        payload.alias("payload"),
        "intact",
    )


def _gather(table: DataFrame, candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """``(file, at, gathered)``: records that run over several candidates, with all their bytes."""
    blocks = lambda low, high: F.explode(F.sequence(F.floor(low / _BLOCK), F.floor(high / _BLOCK)))
    covered = spans.select(
        "file",
        F.col("at").alias("owner"),
        F.col("place").alias("start"),
        "following",
        blocks(F.col("place"), F.col("following")).alias("block"),
    )
    places = candidates.withColumn("block", F.floor(F.col("place") / _BLOCK))
    owned = places.join(covered, ["file", "block"]).where("place >= start AND place < following")
    owned = stage(owned.select("file", "at", "owner", "place"))
    pieces = owned.join(table.select("file", "at", "value"), ["file", "at"])
    listed = F.array_sort(F.collect_list(F.struct("place", F.col("value").cast("string").alias("value"))))
    grouped = pieces.groupBy("file", F.col("owner").alias("at")).agg(listed.alias("pieces"))
    return grouped.select("file", "at", F.array_join("pieces.value", _MAGIC).cast("binary").alias("gathered"))
