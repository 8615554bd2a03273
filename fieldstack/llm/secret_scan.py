"""Secret scan: three base patterns, and strings that stay incompressible next to their surroundings.

Base patterns (leftmost, non-overlapping, per kind): ``assign``, a keyword with a value of 12 or more characters; ``access``,
AKIA keys of 18 or more; ``hex``, lower-case hex runs of 16 or more.

Method: every other run of 16 or more characters of ``[A-Za-z0-9+/_.=-]`` in a sensitive context (a word
such as key, auth or bearer shortly before, on the same line; or a line of a block under a header that has such a word: a PEM body, a
value on the lines after ``key:`` or ``key: |``) is a candidate. Its novelty is its marginal size: the
bytes zstandard needs for it with a dictionary of common identifiers and of the text around it (the candidate left out, and its
copies that stand in a sensitive context themselves; a copy elsewhere counts as spelled out), less those it needs for nothing. A candidate that costs at least ``min_novelty`` of what its characters cost in random order with nothing
known, and mixes letters with digits or both cases, is reported as ``novel``. That full cost is the length up to 63 characters; from
64 on zstandard codes characters by their frequency (hex in 4 bits), so it is measured on the shuffled candidate, and is no less than a
random number's. Identifiers and words that the surroundings or the dictionary spell out cost a few bytes and are no finding.

The bytes of many texts are searched at once for anything that a pattern needs; only texts that have some of it are matched.
Texts are scanned whole, one by one, in bounded batches; nothing is shuffled.

Defined results: a null or empty text has no spans. Rows are scanned each, repeated rows alike. Extra columns pass through; those
named ss_.. are replaced.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import LOWER, flat, own, slices, small_batches

KINDS = ["assign", "access", "hex", "novel"]

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = [b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"]

# Words that make a context sensitive, and common identifiers.
SENSITIVE = ["access", "api", "auth", "bearer", "cert", "cookie", "credential", "hash", "hmac", "jwt", "key", "login",
             "nonce", "oauth", "pass", "private", "pwd", "salt", "secret", "session", "signature", "token"]
IDENTIFIERS = (
    "abstract account address application argument array async attribute authorization await backend base64 begin "
    "boolean browser buffer build builder button cache callback channel class client collection column command "
    "component config configuration connection const constant container content context controller count create "
    "current customer database datetime default define delete description destination development dictionary "
    "directory document element enabled endpoint environment error event example exception execute export extends "
    "factory false field filename filter final float format function generator getElementById getValue handler header "
    "hostname identifier implements import include index initialize input instance integer interface iterator "
    "javascript language length library license listener localhost location manager message method middleware module "
    "namespace network notification null number object operator option organization output override package parameter "
    "password path permission pipeline placeholder platform plugin pointer position prefix previous private process "
    "production profile project property protected protocol provider public query random receive record reference "
    "register release remove repository request resource response result return router runtime schema schedule search "
    "security selector sequence serialize server service session setting signature software source staging standard "
    "static status storage string structure subscription success summary super switch system template terminal testing "
    "thread timeout timestamp token transaction transform true type undefined update upload username validate value "
    "variable version virtual visibility warning websocket window workspace wrapper "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ https:// http://www. .com .org .net .html .json "
).encode()

LITERALS = 64       # length from which zstandard codes characters by their frequency
DIGIT = math.log2(10) / 8

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.A | re.I)
# Lines of blocks: what opens one, what goes on in it (with PEM's attributes and empty lines), what may stand before a value on its line.
OPENS = re.compile(r"[:=][ \t]*[|>]?[+-]?[0-9]?[\"'(\[{]?\\?$")
BODY = re.compile(r"(?:- +)?[\"']?[A-Za-z0-9+/_.=-]+[\"']?[ \t]*[,+\\]?|(?:Proc-Type|DEK-Info|Version|Comment): .*", re.A)
MARGIN = " \t\r\"'-"
LONG_LINE, PEM_LINE = 1000, 8192
_RUN = np.zeros(256, dtype=bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in code points."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


def _mixed(s: str) -> bool:
    letters = any(c.isalpha() for c in s)
    return letters and (any(c.isdigit() for c in s) or (s.lower() != s and s.upper() != s and not s[1:].islower()))


def marginal_bytes(candidate: str, around: str, level: int = 9) -> int:
    """Compressed bytes that ``candidate`` adds when identifiers and the text around it are known."""
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + around.encode("utf-8", "replace"),
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False,
                                      write_dict_id=False)
    return len(packer.compress(candidate.encode())) - len(packer.compress(b""))


def full_bytes(candidate: str, level: int = 9) -> float:
    """Compressed bytes of ``candidate``'s characters if nothing spells them out."""
    n = len(candidate)
    if n < LITERALS:
        return n
    mixed = "".join(random.Random(0).sample(candidate, n)).encode()
    packer = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
    return max(DIGIT * n, min(n, len(packer.compress(mixed)) - len(packer.compress(b""))))


class Contexts:
    """Which places of a text are sensitive."""

    def __init__(self, text: str, before: int):
        self.text, self.before = text, before
        self.blocks: dict[int, bool] = {}
        self.places: dict[int, bool] = {}
        self.runs = [m.span() for m in CANDIDATE.finditer(text)]

    def _block(self, start: int) -> bool:
        """Whether the line at ``start`` goes on a block whose header is sensitive."""
        seen, verdict = [], False
        while start > 0:
            if start in self.blocks:
                verdict = self.blocks[start]
                break
            seen.append(start)
            end = start - 1
            start = self.text.rfind("\n", max(0, end - LONG_LINE), end) + 1
            if not start and end > LONG_LINE:
                break
            line = self.text[start:end].strip()
            if "-----BEGIN" in line or OPENS.search(line):
                verdict = bool(_SENSITIVE.search(line))
                break
            if line and not BODY.fullmatch(line):
                break
        self.blocks.update(dict.fromkeys(seen, verdict))
        return verdict

    def _sensitive(self, lo: int) -> bool:
        text, first = self.text, max(0, lo - self.before)
        if _SENSITIVE.search(text, max(first, text.rfind("\n", first, lo) + 1), lo):
            return True
        # a PEM body on one line, its line ends escaped
        first = max(0, lo - PEM_LINE)
        begin = text.rfind("-----BEGIN", max(first, text.rfind("\n", first, lo) + 1), lo)
        if begin >= 0 and text.find("-----END", begin, lo) < 0 and _SENSITIVE.search(text, begin, min(lo, begin + 64)):
            return True
        # the first thing on its line, which a block may hold
        start = text.rfind("\n", max(0, lo - LONG_LINE), lo) + 1
        return start > 0 and not text[start:lo].strip(MARGIN) and self._block(start)

    def sensitive(self, lo: int) -> bool:
        if lo not in self.places:
            self.places[lo] = self._sensitive(lo)
        return self.places[lo]

    def _copy(self, at: int) -> bool:
        """Whether what stands at ``at``, or the run of characters that holds it, is in a sensitive context."""
        run = bisect.bisect_right(self.runs, (at, len(self.text))) - 1
        return self.sensitive(at) or run >= 0 and at < self.runs[run][1] and self.sensitive(self.runs[run][0])

    def around(self, lo: int, hi: int, around: int) -> str:
        """The text around a candidate, without its copies in sensitive contexts."""
        first, last = max(0, lo - around), hi + around
        core = self.text[lo:hi].strip("+/_.=-")
        parts, done = [], first
        # copies that reach over the edge count as well
        at = self.text.find(core, max(0, first - len(core)), last + len(core))
        while at >= 0:
            if lo <= at < hi:
                cut = (lo, hi)
            elif self._copy(at):
                cut = (at, at + len(core))
            else:
                cut = None
            if cut:
                parts.append(self.text[done:min(cut[0], last)])
                done = max(done, cut[1])
            at = self.text.find(core, cut[1] if cut else at + 1, last + len(core))
        return " ".join([*parts, self.text[done:last]])


def novel_spans(text: str, taken: list[tuple[int, int, int]], min_novelty: float, before: int,
                around: int) -> list[tuple[int, int, int]]:
    out, at, contexts = [], 0, Contexts(text, before)
    for m in CANDIDATE.finditer(text):
        lo, hi = m.span()
        while at < len(taken) and taken[at][1] <= lo:
            at += 1
        if any(s < hi and lo < e for s, e, _ in taken[at:at + 3]) or not _mixed(m[0]):
            continue
        if not contexts.sensitive(lo):
            continue
        if marginal_bytes(m[0], contexts.around(lo, hi, around)) >= min_novelty * full_bytes(m[0]):
            out.append((lo, hi, 3))
    return out


def scan(text: str, min_novelty: float = 0.8, before: int = 40, around: int = 2000) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    ends = sorted(spans, key=lambda s: s[1])
    return sorted(spans + novel_spans(text, ends, min_novelty, before, around))


def _worth(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts that may hold a span: a keyword, or a run of 16 candidate characters."""
    n = len(offs) - 1
    out = np.zeros(n, dtype=bool)
    low = LOWER[buf].tobytes()
    for word in KEYWORDS:
        at = low.find(word)
        while at >= 0:
            text = int(np.searchsorted(offs, at, side="right")) - 1
            out[text] = True
            at = low.find(word, int(offs[text + 1]))
    run = _RUN[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], run, [False]]).astype(np.int8)))
    lo, hi = edge[::2], edge[1::2]
    long = hi - lo >= 16
    # a run may go on in the next text: all that it touches are looked at
    for a, b in zip(lo[long].tolist(), hi[long].tolist()):
        first, last = np.searchsorted(offs, [a, b - 1], side="right") - 1
        out[first:last + 1] = True
    return out


def secret_scan(docs: DataFrame, min_novelty: float = 0.8, before: int = 40, around: int = 2000,
                keep_text: bool = True) -> DataFrame:
    """``docs`` plus ss_spans: array of (start, end, kind) in code points, by start and then kind."""
    small_batches(docs.sparkSession)
    docs = own(docs, "ss_")
    names = [c for c in docs.columns if keep_text or c != "text"]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("kind", T.StringType())])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                worth = _worth(*flat(piece.column("text")))
                found: list[list[dict]] = [[] for _ in range(piece.num_rows)]
                column = piece.column("text")
                for i in np.flatnonzero(worth).tolist():
                    found[i] = [{"start": a, "end": b, "kind": KINDS[k]}
                                for a, b, k in scan(column[i].as_py() or "", min_novelty, before, around)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), pa.array(found, arrow)],
                                                 [*names, "ss_spans"])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in names),
                                              T.StructField("ss_spans", T.ArrayType(span))]))
