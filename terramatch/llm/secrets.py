"""Secret scans: an Aho-Corasick pass over keywords, anchored regular expressions at its hits, then embedded checksums."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc(body: str) -> str:
    """The six base-62 digits of a text's CRC-32 with which some issuers end their tokens."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _token_checks(m: re.Match) -> bool:
    body = m.group(1)
    return base62_crc(body[:-6]) == body[-6:]


def _jwt_checks(m: re.Match) -> bool:
    """The first part of a web token is JSON that names an algorithm."""
    head = m.group(0).split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, TypeError):
        return False


BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def _base58_checks(m: re.Match) -> bool:
    """An extended private key: 78 bytes and the first four of their double SHA-256."""
    n = 0
    for c in m.group(0):
        n = n * 58 + BASE58.index(c)
    if n >> (82 * 8):
        return False
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


#: Kind: keywords in lower case, the expression anchored at a keyword, and what a match must pass. Base kinds come first; hex has no keyword.
KINDS: dict[str, tuple[tuple[str, ...], re.Pattern | None, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), lambda m: len(m.group(2)) >= 6),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group(0)) >= 20),
    "hex": ((), None, lambda m: True),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _token_checks),
    "npm": (("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _token_checks),
    "jwt": (("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]{8,}+"), _jwt_checks),
    "xprv": (("xprv",), re.compile(r"xprv([1-9A-HJ-NP-Za-km-z]{107})(?![1-9A-HJ-NP-Za-km-z])"), _base58_checks),
    "pem": (("-----begin",), re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----"), lambda m: True),
}
#: Kinds whose expression reads a run of these characters from its start on. What follows the run is the same for all starts within it, so
#: after one failure the later starts, whose part of the run is shorter, fail too and are not tried.
RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]+")}
BASE = ("assign", "access", "hex")
ORDER = {k: i for i, k in enumerate(KINDS)}
HEX_RUN = re.compile(r"[0-9a-f]{24,}")

_automaton: ahocorasick.Automaton | None = None


def automaton() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for kind, (words, _, _) in KINDS.items():
            for w in words:
                _automaton.add_word(w, (kind, len(w)))
        _automaton.make_automaton()
    return _automaton


def lowered(text: str) -> str:
    """ASCII letters in lower case, all else and all positions as they were."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, end exclusive, by start and then by kind.

    Within a kind, matches go from left to right and don't overlap; a match that fails its check takes its place in that order
    and is then dropped. A match can only start at a keyword, so trying the expression at the keywords alone loses none. A run
    of hexadecimal digits has no keyword; its own expression is one character class and runs over the text.
    """
    found, until = [], dict.fromkeys(KINDS, 0)
    hits = [(end + 1 - size, kind) for end, (kind, size) in automaton().iter(lowered(text))]
    if hits:
        hits.sort()
        for start, kind in hits:
            if start < until[kind]:
                continue
            if m := KINDS[kind][1].match(text, start):
                until[kind] = m.end()
                if KINDS[kind][2](m):
                    found.append((start, m.end(), kind))
            elif kind in RUNS and text.startswith("eyJ", start):
                until[kind] = RUNS[kind].match(text, start).end()
    found += [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]
    return sorted(found, key=lambda x: (x[0], ORDER[x[2]]))


SPANS = "array<struct<kind string, start long, end long>>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for a, b, k in scan(x.as_py())] for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, type=kind)], ["id", "spans"])


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: id, spans (kind, start, end in code points).

    Scale: no shuffle; texts stream through an automaton of a dozen keywords, and the time for a text is proportional to its length.

    Defined results: a null or empty text has no spans; a null id stays null; each row is scanned by itself; an empty table gives
    an empty one. Ids are whole numbers. Further columns are left out.
    """
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(_scanned, f"id long, spans {SPANS}")


def joined(spans: Column) -> Column:
    """kind:start:end of spans, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def is_base(span: Column) -> Column:
    return span["kind"].isin(*BASE)
