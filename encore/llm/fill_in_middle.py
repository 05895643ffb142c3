"""Fill-in-the-middle documents by in-place block rotation (operator 13).

Method. The units of a text (lines or code points) are scanned for their ends.
Two cuts, drawn from a hash of the doc_id, divide it into prefix, middle and
suffix. The text becomes a bytearray, the sentinels are inserted where they
stand in reading order (``<P>`` prefix ``<M>`` middle ``<S>`` suffix), and
neighbouring blocks are exchanged in place by three reversals: the last two
blocks give the form ``psm``, the suffix against all before it ``spm``. Going
back, the sentinels are found, the same rotation is inverted, and they are
taken out again.

Texts are handled as UTF-8 bytes: no sentinel and no cut falls inside a
character, so no text is decoded. A text that holds a sentinel stays ``plain``,
which makes the sentinels of all others unique; sentinels must not be able to
overlap one another (checked).

Defined results: null text is empty and plain; a null doc_id is hashed as the
empty text; rows that repeat an id get the same hash, each with its own text;
other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.words import chunks, text_bytes


class Plan(NamedTuple):
    """What to cut and how often: percentages are of documents, by hash."""
    seed: int = 7
    rate: int = 100                    # percent of texts that are transformed
    spm: int = 50                      # percent of these with the suffix first
    unit: str = "line"                 # or "char"
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def check(self) -> Plan:
        marks = (self.prefix, self.suffix, self.middle)
        if self.unit not in ("line", "char") or not all(marks) or len(set(marks)) < 3:
            raise ValueError("unit is line or char, sentinels are three different texts")
        for a in marks:
            for b in marks:
                if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, len(b)) if k < len(a)):
                    raise ValueError(f"sentinels {a!r} and {b!r} can overlap")
        return self


def unit_ends(raw: np.ndarray, unit: str) -> np.ndarray:
    """End of each unit of a text, in bytes. A line ends with its newline."""
    if not len(raw):
        return np.zeros(0, np.int64)
    if unit == "char":
        return np.r_[np.flatnonzero((raw & 0xC0) != 0x80)[1:], len(raw)]
    ends = np.flatnonzero(raw == 10) + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.r_[ends, len(raw)]


def rotate(buffer: bytearray, begin: int, border: int) -> None:
    """Exchange buffer[begin:border] and buffer[border:] in place: each block
    is reversed, then both together."""
    both = np.frombuffer(buffer, np.uint8)[begin:]
    for block in (both[:border - begin], both[border - begin:], both):
        block[:] = block[::-1]


def arrange(raw: bytes, first: int, second: int, form: str, plan: Plan) -> bytes:
    """The text with its sentinels, cut at two bytes, in the order of ``form``."""
    out = bytearray(raw)
    out[second:second] = plan.suffix
    out[first:first] = plan.middle
    out[0:0] = plan.prefix
    first += len(plan.prefix)
    second += len(plan.prefix) + len(plan.middle)
    rotate(out, first if form == "psm" else 0, second)
    return bytes(out)


def rebuild(output: bytes, form: str, plan: Plan) -> bytes:
    """The text that :func:`arrange` was given."""
    if form == "plain":
        return output
    out = bytearray(output)
    begin = out.index(plan.suffix)
    rotate(out, begin, out.index(plan.middle if form == "psm" else plan.prefix))
    for mark in (plan.suffix, plan.middle, plan.prefix):
        at = out.index(mark)
        del out[at:at + len(mark)]
    return bytes(out)


def _numbers(seed: int, doc_id: int | None) -> list[int]:
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return np.frombuffer(digest, ">u4", 4).tolist()


def _chars(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _texts(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary()).view(pa.large_string()).cast(pa.string())


def transform(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and
    output of every document."""
    plan.check()
    marks = (plan.prefix, plan.suffix, plan.middle)

    def one(doc_id, raw: np.ndarray):
        ends = unit_ends(raw, plan.unit)
        n, text = len(ends), raw.tobytes()
        h1, h2, h3, h4 = _numbers(plan.seed, doc_id)
        if not text or h3 % 100 >= plan.rate or any(m in text for m in marks):
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        first, second = (int(ends[k - 1]) if k else 0 for k in (low, high))
        form = "spm" if h4 % 100 < plan.spm else "psm"
        return n, form, _chars(raw[:first]), _chars(raw[first:second]), \
            arrange(text, first, second, form, plan)

    def go(batches):
        for b in chunks(batches):
            raw, at = text_bytes(b.column(1))
            n, form, before, between, output = zip(*(
                one(d, raw[s:e]) for d, s, e in zip(b.column(0).to_pylist(), at[:-1], at[1:])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(before, pa.int64()), pa.array(between, pa.int64()), _texts(list(output))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        go, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of :func:`transform` with the text rebuilt from output and form
    alone, as ``restored``."""
    plan.check()

    def go(batches):
        for b in chunks(batches, "output"):
            at = b.schema.get_field_index
            raw, off = text_bytes(b.column(at("output")))
            forms = b.column(at("form")).to_pylist()
            back = [rebuild(raw[s:e].tobytes(), f, plan) for f, s, e in zip(forms, off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, _texts(back)],
                                             names=[*b.schema.names, "restored"])

    schema = T.StructType([*transformed.schema.fields, T.StructField("restored", T.StringType())])
    return transformed.mapInArrow(go, schema)


def digest_query(docs: DataFrame) -> DataFrame:
    """The contract's rows: digests of the outputs and of the rebuilt texts."""
    def digest(name):
        return F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256")

    return restore(transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
