"""Features of GeoJSON collections in any layout, from one line to pretty-printed.

Files are read as text cut after every closing brace, so Spark splits them wherever they
are long and no piece is longer than the way from one brace to the next. Where a feature
begins and ends follows from the depth of brackets outside strings, which depends on
everything before: a first pass over the splits says what each does to the state (inside
a string or not, brackets closed, brackets left open), whatever state it starts in; a
prefix scan over the few splits of a file gives each its state; a second pass then cuts
features where they end. A feature over the edge of splits is put together from its parts.

``features`` of a root object hold the features; a root object without that member counts
as a feature itself, so files of one feature after the other are read as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_FEATURES = re.compile(rb'"features"\s*:\s*\[')
_BETWEEN = b" \t\r\n,\x1e\xef\xbb\xbf"  # what may stand between features, and before a file's first byte

MOVES = "array<struct<inside:boolean,pops:int,pushes:string,seen:array<int>>>"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``doc, start, last, value``: text of each split of each file, in order, without its closing braces."""
    text = spark.read.text(path, lineSep="}")
    end = F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")
    return text.select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("start"),
        (end >= F.col("_metadata.file_size")).alias("last"),
        "value",
    )


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bytes]]:
    """Split, rows and text of each run of rows of one split, its braces put back.

    What follows a file's last brace ends without one; only white space may.
    """
    now, rows, bare = None, None, True
    for batch in batches:
        doc, start = batch.column("doc").to_pylist(), batch.column("start").to_pylist()
        first = 0
        for i in range(1, batch.num_rows + 1):
            if i < batch.num_rows and (doc[i], start[i]) == (doc[first], start[first]):
                continue
            split = (doc[first], start[first])
            if split != now and not bare:
                yield now, rows, b"}"
            rows = batch.slice(first, i - first)
            values = rows.column("value").to_pylist()
            yield split, rows, ("}" * (split == now) + "}".join(values)).encode()
            now, bare, first = split, rows.column("last")[0].as_py() and not values[-1].strip(), i
    if not bare:
        yield now, rows, b"}"


def quotes(data: np.ndarray) -> np.ndarray:
    """Places of quotation marks that no backslash escapes."""
    found = np.flatnonzero(data == ord('"'))
    if len(found) and (data[found - 1] == ord("\\")).any():
        at = np.arange(len(data))
        before = np.maximum.accumulate(np.where(data != ord("\\"), at, -1))  # last place without a backslash
        run = np.where(found > 0, found - 1 - before[found - 1], 0)
        found = found[run % 2 == 0]
    return found


class Piece:
    """Brackets of a piece of text that starts inside or outside a string."""

    def __init__(self, text: bytes, inside: bool):
        data = np.frombuffer(text, np.uint8)
        marks = quotes(data)
        at = np.flatnonzero(_STEP[data])
        within = (np.searchsorted(marks, at) & 1).astype(bool) ^ inside
        self.text, self.at = text, at[~within]
        self.step = _STEP[data[self.at]].astype(np.int64)
        self.inside = inside ^ bool(len(marks) & 1)
        named = [m.end() - 1 for m in _FEATURES.finditer(text)]
        self.named = np.isin(self.at, named)  # opens an array called features


class Move:
    """What a split does to the state, if it starts inside or outside a string."""

    def __init__(self, inside: bool):
        self.inside, self.pops, self.pushes, self.seen = inside, 0, "", []

    def add(self, text: bytes) -> None:
        piece = Piece(text, self.inside)
        self.inside = piece.inside
        if not len(piece.at):
            return
        base = len(self.pushes) - self.pops  # depth here, from the start of the split
        depth = base + np.cumsum(piece.step)
        low = int(min(base, depth.min()))
        keep = max(0, low + self.pops)
        self.pops = max(self.pops, -low)
        later = np.minimum.accumulate(depth[::-1])[::-1]
        open_ = np.flatnonzero((piece.step > 0) & (later >= depth))
        signs = ["F" if piece.named[k] else chr(piece.text[piece.at[k]]) for k in open_.tolist()]
        self.pushes = self.pushes[:keep] + "".join(signs)
        held = np.flatnonzero(piece.named & (later >= depth - 1))
        self.seen = sorted({s for s in self.seen if s - 1 <= low} | set(depth[held].tolist()))


def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: what it does to either state."""
    schema = pa.schema(
        [("doc", pa.string()), ("start", pa.int64())]
        + [("moves", pa.list_(pa.struct([("inside", pa.bool_()), ("pops", pa.int32()), ("pushes", pa.string()), ("seen", pa.list_(pa.int32()))])))]
    )
    now, both = None, []

    def row() -> pa.RecordBatch:
        said = [{"inside": m.inside, "pops": m.pops, "pushes": m.pushes, "seen": m.seen} for m in both]
        return pa.record_batch([[now[0]], [now[1]], pa.array([said], schema.field("moves").type)], schema=schema)

    for split, _, text in texts(batches):
        if split != now:
            if now is not None:
                yield row()
            now, both = split, [Move(False), Move(True)]
        for move in both:
            move.add(text)
    if now is not None:
        yield row()


def level(stack: str) -> int:
    """Depth at which the item open in a state began: 3 in a collection, 1 at the root, 0 if none."""
    if stack[1:2] == "F":
        return 3 if len(stack) > 2 else 0
    return 1 if stack[:1] in ("{", "[") else 0


def after(stack: str, move: dict) -> tuple[str, int]:
    """State after a split, and the least depth within it; a root that had its features is ``D``."""
    low = len(stack) - move["pops"]
    kept = stack[: max(0, low)]
    if stack[1:2] == "F" and len(kept) == 1:
        kept = "D"
    out = kept + move["pushes"]
    if any(len(stack) + s == 2 for s in move["seen"]) and out[1:2] != "F":
        out = "D" + out[1:]
    return out, low


STATES = "doc string, start long, inside boolean, stack string, owner long"


def prefix(strict: bool):
    """State before each split of a file, and the split where the item open there began."""

    def scan(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        inside, stack, owner, out = False, "", None, []
        for r in rows:
            out.append({"doc": r["doc"], "start": r["start"], "inside": inside, "stack": stack, "owner": owner})
            move, before = r["moves"][int(inside)], stack
            stack, low = after(stack, move)
            inside = move["inside"]
            if low < 0 and strict:
                raise ValueError(f"no feature collection: {r['doc']} closes a bracket that is not open")
            same = level(stack) == level(before) > 0 and low >= level(before)
            owner = None if not level(stack) else owner if same else r["start"]
        if strict and (stack or inside):
            raise ValueError(f"no feature collection: {rows[0]['doc']} ends within {stack or 'a string'}")
        return pa.Table.from_pylist(
            out,
            pa.schema([("doc", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("stack", pa.string()), ("owner", pa.int64())]),
        )

    return scan


class Cutter:
    """Cuts the items out of one split, from the state it starts in."""

    def __init__(self, doc: str, start: int, inside: bool, stack: str, owner: int | None, strict: bool):
        self.doc, self.start, self.inside, self.strict = doc, start, inside, strict
        self.depth, self.owner = len(stack), owner
        self.root_done, self.in_features = stack[:1] == "D", stack[1:2] == "F"
        self.open = level(stack)  # depth of the item that is open
        self.held: list[bytes] = []
        self.rows: list[tuple[int | None, int, str | None]] = []

    def fault(self, text: bytes) -> None:
        if self.strict and text.strip(_BETWEEN):
            raise ValueError(f"no feature: {self.doc} holds {text.strip(_BETWEEN)[:200]!r} between features")

    def close(self, part: bytes) -> None:
        self.held.append(part)
        self.rows.append((self.owner, self.start, b"".join(self.held).decode("utf-8", "replace")))
        self.held, self.owner, self.open = [], None, 0

    def drop(self) -> None:
        """The root object turns out to be a collection and no feature."""
        if self.owner is not None:
            self.rows.append((self.owner, self.start, None))
        self.held, self.owner, self.open = [], None, 0

    def add(self, text: bytes) -> None:
        piece = Piece(text, self.inside)
        self.inside = piece.inside
        depth = self.depth + np.cumsum(piece.step)
        # Only brackets at the depths of items matter; those within a feature are passed over.
        step = piece.step
        near = np.flatnonzero(((step > 0) & (depth <= 3)) | ((step < 0) & (depth <= 2)))
        from_ = 0  # first byte not yet given to an item or looked at
        for k in near.tolist():
            at, d, opens = int(piece.at[k]), int(depth[k]), step[k] > 0
            if opens and d == 1:
                self.fault(text[from_:at])
                self.root_done, self.in_features, self.open, from_ = False, False, 1, at
            elif opens and d == 2 and piece.named[k] and not self.root_done:
                self.drop()
                self.root_done = self.in_features = True
                from_ = at + 1
            elif opens and d == 3 and self.in_features:
                self.fault(text[from_:at])
                self.open, from_ = 3, at
            elif not opens and d == 2 and self.open == 3:
                self.close(text[from_ : at + 1])
                from_ = at + 1
            elif not opens and d == 1 and self.in_features:
                self.fault(text[from_:at] + (b"" if text[at] == ord("]") else b"}"))
                self.in_features, from_ = False, at + 1
            elif not opens and d <= 0:
                if self.open == 1:
                    self.close(text[from_ : at + 1])
                elif text[at] != ord("}"):
                    self.fault(b"]")
                self.root_done = self.in_features = False
                from_ = at + 1
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if self.open:
            self.held.append(text[from_:])
        elif self.in_features or self.depth == 0:
            self.fault(text[from_:])

    def end(self) -> list[tuple[int | None, int, str | None]]:
        if self.open and self.held:
            owner = self.start if self.owner is None else self.owner
            self.rows.append((owner, self.start, b"".join(self.held).decode("utf-8", "replace")))
        return self.rows


ITEMS = "doc string, owner long, start long, body string"


def cut(strict: bool):
    schema = pa.schema([("doc", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("body", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cutter = None, None

        def rows(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [(), (), ()]
            return pa.record_batch([pa.array([cutter.doc] * len(found), pa.string()), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema)

        for split, part, text in texts(batches):
            if split != now:
                if cutter is not None:
                    yield rows(cutter.end())
                state = {c: part.column(c)[0].as_py() for c in ("inside", "stack", "owner")}
                if state["stack"] is None:
                    raise ValueError(f"the split {split} was not there in the first pass")
                now, cutter = split, Cutter(*split, **state, strict=strict)
            cutter.add(text)
            if cutter.rows:
                yield rows(cutter.rows)
                cutter.rows = []
        if cutter is not None:
            yield rows(cutter.end())

    return work


def collection_items(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``body``: the JSON text of every feature of the files, in whatever layout.

    The states of the splits, some hundred bytes for each split of a file, are broadcast:
    the rows must stay in the order of the file. With ``strict``, text between features,
    a file that ends within one, or a bracket too many is an error.
    """
    text = pieces(spark, path)
    done = text.mapInArrow(moves, f"doc string, start long, moves {MOVES}")
    states = done.groupBy("doc").applyInArrow(prefix(strict), STATES)
    stated = text.join(F.broadcast(states), ["doc", "start"], "left")
    found = stated.mapInArrow(cut(strict), ITEMS)
    parts = found.filter("owner is not null").groupBy("doc", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", F.coalesce("body", F.lit("")).alias("body"), F.col("body").isNull().alias("void")))).alias("parts")
    )
    joined = parts.filter(~F.exists("parts", lambda p: p["void"]))
    whole = joined.select(F.array_join(F.transform("parts", lambda p: p["body"]), "").alias("body"))
    return found.filter("owner is null").select("body").unionByName(whole)


def features(items: DataFrame, properties: str, strict: bool = True) -> Column:
    """Struct ``type, properties, geometry`` of the column ``body``; no feature is an error or null."""
    kind = f"struct<type: string, properties: struct<{properties}>, geometry: string>"
    schema = kind[:-1] + ", _bad: string>"
    parsed = F.from_json("body", schema, {"columnNameOfCorruptRecord": "_bad"})
    good = parsed["_bad"].isNull() & (parsed["type"] == "Feature")
    fault = F.raise_error(F.concat(F.lit("no feature: "), F.substring("body", 1, 200))).cast(kind)
    one = F.struct(parsed["type"].alias("type"), parsed["properties"].alias("properties"), parsed["geometry"].alias("geometry"))
    return F.when(good, one).otherwise(fault if strict else F.lit(None).cast(kind))
