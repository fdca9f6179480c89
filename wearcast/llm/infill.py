"""Fill-in-middle transformation by block rotation in place.

A text is cut twice at unit ends (a unit is a word with the white space before
it, or the white space a text ends with).  The three sentinels are inserted
into one bytearray in reading order, prefix, middle, suffix; the segments then
change places by a three-reversal rotation of that array.  Rotating back
and taking the sentinels out restores the text exactly.  Sentinels begin with
``<`` and end with ``>`` and hold neither inside, so none can arise across a
cut; texts that hold one of their own stay plain.

Two ways to order the segments: ``psm`` (prefix, suffix, middle) and ``spm``
(suffix, prefix, middle).  Cuts and order follow from the document id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import SPACE, blocks, raw_text, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
#: Percent of texts that are cut, and of those the percent in spm order.
RATE, SPM = 50, 80
_SWAP = 1 << 16
FIELDS = "struct<units:bigint,form:string,output:string,prefix_chars:bigint,middle_chars:bigint>"


def unit_ends(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of all units of a block's texts as byte positions, first unit of
    each text): a unit ends with a run of other bytes, or with the text."""
    n = len(buf)
    last = np.zeros(n, bool)
    if n:
        gap = SPACE[buf]
        last[:-1] = ~gap[:-1] & gap[1:]
        last[offsets[(offsets > 0)] - 1] = True  # texts end here; empty ones share the place
    ends = np.flatnonzero(last) + 1
    return ends, np.searchsorted(ends, offsets, "right")


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Reverse view[a:b] in place, swapping pieces of bounded size from both ends."""
    while b - a > 1:
        k = min(_SWAP, (b - a) // 2)
        left = view[a : a + k].copy()
        view[a : a + k] = view[b - k : b][::-1]
        view[b - k : b] = left[::-1]
        a, b = a + k, b - k


def rotate(buf: bytearray, a: int, m: int, b: int) -> None:
    """Exchange the neighbours buf[a:m] and buf[m:b] in place by three reversals."""
    view = np.frombuffer(buf, np.uint8)
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """``text`` cut at the two byte positions, with sentinels, in the order of ``form``."""
    buf = bytearray(text)
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[:0] = PREFIX
    middle, suffix = first + MARK, second + 2 * MARK
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return buf


def rebuild(output: bytes, form: str) -> bytearray:
    """The text that ``arrange`` was given."""
    buf = bytearray(output)
    if form == "psm":
        suffix, middle = buf.index(SUFFIX), buf.index(MIDDLE)
        rotate(buf, suffix, middle, len(buf))
    else:
        rotate(buf, 0, buf.index(PREFIX), len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(mark)
        del buf[at : at + MARK]
    return buf


def _code_points(buf: np.ndarray) -> int:
    return int(np.count_nonzero((buf & 0xC0) != 0x80))


def _texts(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary()).cast(pa.string())


def _cut_block(b: pa.RecordBatch, rate: int, spm: int) -> pa.StructArray:
    buf, offsets = raw_text(b.column("text"))
    ends, first = unit_ends(buf, offsets)
    n = np.diff(first)
    h = [np.asarray(b.column(f"h{i}")) for i in range(1, 5)]
    x, y = h[0] % (n + 1), h[1] % (n + 1)
    held = np.zeros(len(n), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        held |= np.asarray(pc.fill_null(pc.match_substring(b.column("text"), mark.decode()), False))
    plain = (n == 0) | held | (h[2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(h[3] % 100 < spm, "spm", "psm"))
    edge = np.append(0, ends)  # edge[i]: where unit i of the block begins, i units after its start
    cuts = [np.where(k > 0, edge[first[:-1] + k], offsets[:-1]) for k in (np.minimum(x, y), np.maximum(x, y))]
    prefix, middle = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    out = []
    for i, (a, z, p, q) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), cuts[0].tolist(), cuts[1].tolist())):
        text = buf[a:z].tobytes()
        if not plain[i]:
            prefix[i], middle[i] = _code_points(buf[a:p]), _code_points(buf[p:q])
            text = bytes(arrange(text, p - a, q - a, form[i]))
        out.append(text)
    return pa.StructArray.from_arrays(
        [pa.array(n.astype(np.int64)), pa.array(form.tolist(), pa.string()), _texts(out),
         pa.array(prefix, mask=plain), pa.array(middle, mask=plain)],
        ["units", "form", "output", "prefix_chars", "middle_chars"])


def _joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = RATE, spm: int = SPM, out: str = "fim") -> DataFrame:
    """All rows and columns of ``docs`` plus the struct ``out``: units (how many
    the text has), form (plain, psm or spm), output, and the code points of
    prefix and middle (null if plain).

    The choice follows from sha256 of ``seed:doc_id``, so rows with the same
    id are cut alike and a rerun gives the same rows; a null id counts as
    empty.  A null text is empty and plain, as are texts that hold a sentinel.
    Texts are whole, however long: one text is in memory at a time beside its
    batch.  An empty table gives no rows.  A column named ``out`` already is
    an error; other names cannot clash."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    kind = pa.struct([("units", pa.int64()), ("form", pa.string()), ("output", pa.string()),
                      ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            whole = pa.RecordBatch.from_arrays(list(batch), ["text", "h1", "h2", "h3", "h4"])
            yield _joined([_cut_block(b, rate, spm) for b in blocks([whole], "text")], kind)

    run.__annotations__ = {"columns": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(run, FIELDS)(F.col("text").cast("string"), *draw))


def restored(output: Column, form: Column) -> Column:
    """The text behind an output of ``fill_in_middle`` (null: null)."""

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in columns:
            yield pa.array([None if o.as_py() is None else o.as_py() if f.as_py() == "plain"
                            else rebuild(o.as_py().encode(), f.as_py()).decode() for o, f in zip(outputs, forms)],
                           pa.string())

    run.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(output, form)


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u FROM documents),
e AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {RATE}
                  THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM e),
s AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
             coalesce(array_to_string(u[b + 1:], ''), '') AS x FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
                        ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM s
"""


@query("op13_block_rotation", SQL)
def op13(spark, sf_dir):
    """Fill-in-middle form of every document, and the text rebuilt from it."""
    done = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fim = F.col("fim")
    return done.select("doc_id", fim["units"].alias("n"), fim["form"].alias("form"),
                       fim["prefix_chars"].alias("prefix_chars"), fim["middle_chars"].alias("middle_chars"),
                       F.sha2(fim["output"], 256).alias("output_sha256"),
                       F.sha2(restored(fim["output"], fim["form"]), 256).alias("restored_sha256"))
