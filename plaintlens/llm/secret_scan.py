"""Secret scan: patterns, and zstandard novelty for opaque strings in a sensitive context.

Base kinds are found by their patterns. The method adds strings of 12 or more opaque characters that are
assigned to a sensitive name but fit no base kind. How new such a string is, is measured: its marginal
compressed bytes are the size of its surroundings compressed with it, less their size without it,
by a compressor primed with a dictionary of identifiers. A placeholder or an identifier that the
dictionary or the surroundings hold costs a few bytes; a key costs nearly its own length and is reported.

Defined cases: null text counts as empty and has no span. Any text length is read whole. Repeated rows
are scanned alike, an empty table gives an empty result, extra columns take no part. Spans are
code points, end exclusive; of equal starts, kinds come in the order of KINDS.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "opaque")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: A sensitive name, what may stand between it and its value, and the value.
SENSITIVE = re.compile(
    r"""(?ai:passphrase|passw(?:or)?d|pwd|secret|token|api[-_\x20]?key|access[-_\x20]?key|private[-_\x20]?key|credentials?|bearer|authorization)"""
    r"""[\w.-]{0,16}["'\])>]{0,3}\s{0,4}(?:=>|:=|[:=]|\x20is\x20|\x20)\s{0,4}(?ai:basic\x20|bearer\x20)?["'(<\[]{0,3}([A-Za-z0-9+/_.=~!@#$%^&*-]{12,})"""
)
#: Code points on each side that count as surroundings.
AROUND = 200
#: Least marginal bytes, as a share of the string's length.
NOVEL = 0.7

#: What placeholders and identifiers are made of; fixed values.
IDENTIFIERS = """
password passwd passphrase secret token api_key apikey access_key private_key credential credentials bearer
authorization username user admin root default example sample placeholder changeme change_me your_password_here
your_api_key_here your_token_here your_secret_here insert_key_here xxxxxxxxxxxxxxxx 0000000000000000 1234567890
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 test testing localhost config configuration
environment variable settings value string number boolean object function return import export require module
class public static final void const let var process.env os.environ getenv get_secret get_password get_token
generate_token refresh_token access_token csrf_token session_token client_secret client_id user_id
database connection server host port service account storage bucket region endpoint request response header
encrypted encryption decrypt signature certificate documentation information authentication
"""


class Scanner:
    """Finds spans; holds the primed compressor, so one for each task."""

    def __init__(self, identifiers: str = IDENTIFIERS, novel: float = NOVEL) -> None:
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=12, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.novel = novel

    def novelty(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bytes of text[start:end] against its surroundings, by its length."""
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        without = len(self.packer.compress((before + after).encode(errors="replace")))
        whole = len(self.packer.compress((before + text[start:end] + after).encode(errors="replace")))
        return (whole - without) / (end - start)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Base spans and added ones, by start, then kind."""
        found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        taken = [(start, end) for _, start, end in found]
        for m in SENSITIVE.finditer(text):
            start, end = m.span(1)
            if not any(a < end and start < b for a, b in taken) and self.novelty(text, start, end) >= self.novel:
                found.append(("opaque", start, end))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SCHEMA = "spans array<struct<kind: string, start: long, end: long>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scanner.spans(t.as_py() or "")] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, SPANS)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {dict(docs.dtypes)['doc_id']}, {SCHEMA}")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans, of every row."""
    spans = F.col("spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in BASE]
    counts = [(F.size(kinds) - n).cast("long").alias(f"n_{k}") for n, k in zip(counts, BASE, strict=True)]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return scan(docs).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
