"""Secret scan with a recursive decoding worklist.

Each text is a layer. Layers are scanned for secrets and for encoded runs (percent escapes, Unicode
escapes, character references, base64 in either alphabet, hex, gzip or zlib below any of them); each
run that decodes is a new layer, until none is new. A digest of every layer's content stops cycles and
repeats. A layer keeps, for its run in the parent, the span of the original text it came from, so what
is found in it is reported there; findings of escape layers map through the exact place of every
character.

Nothing is judged by a sample of it. A run of base64 letters is tried from its start and behind every
`/`, `_`, `-`, `+` in it, since a path may stand before it, and joined over line breaks; decoded bytes make a layer
if any dozen of them in a row is printable, which every secret and every further wrapping needs;
bytes that are no text stay in the layer as marks between its readable pieces. All members of an
archive are read, and what a cut-off one still gives.

An archive may grow a thousandfold, so its contents are scanned in windows of `window` bytes that
overlap by a sixteenth: memory is bounded, nothing is skipped, and only a single wrapped run longer than the overlap
that lies across a border of windows is seen in parts. `n_unscanned` counts archives that end early or break off.

Nulls: a null text is empty; ids may be null or repeat, every row is scanned by itself. Columns of
other names are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

ESCAPES = re.compile(
    r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});"
)
#: Letters of base64 in both alphabets, hex among them; a run goes on in the next line.
PACKED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)*={0,2}")
_BREAK = re.compile(r"[\x20\t]*\r?\n[\x20\t]*")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9._~+-])+")
_PRINTABLE = re.compile(rb"[\x20-\x7e\t\r\n]{12}")
_HEX = re.compile(r"[0-9a-fA-F]{24,}")
STEP = 1 << 16
WINDOW = 64 << 20


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Secrets of one layer, in its own code points."""
    found = []
    lowered = text.encode("utf-8", "surrogatepass").lower()
    if any(word in lowered for word in _KEYWORDS):
        found += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"akia" in lowered:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _unescape(run: str) -> str | None:
    try:
        if run[0] == "%":
            return bytes.fromhex(run.replace("%", "")).decode()
        if run[0] == "&":
            return chr(int(run[3:-1], 16) if run[2] == "x" else int(run[2:-1]))
        if run[1] == "u":
            return bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be")
        return bytes.fromhex(run.replace("\\x", "")).decode()
    except (ValueError, OverflowError):
        return None


def _archive(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0)


class _Cut(Exception):
    """An archive that ends early or breaks off."""


def _unzipped(data: bytes, window: int) -> Iterator[bytes]:
    """Contents of gzip or zlib data, all members, in overlapping windows; _Cut at the end of a damaged one."""
    kept = b""
    while _archive(data):
        unpack, at, step = zlib.decompressobj(47), 0, STEP
        while not unpack.eof:
            if at >= len(data):
                yield kept
                raise _Cut
            before, piece = unpack.copy(), data[at : at + step]
            try:
                kept += unpack.decompress(piece, window - len(kept))
            except zlib.error:
                if step == 1:
                    yield kept
                    raise _Cut from None
                unpack, step = before, 1  # go up to the broken place byte by byte
                continue
            at += len(piece) - len(unpack.unconsumed_tail) - len(unpack.unused_data)
            if len(kept) >= window:
                yield kept
                kept = kept[-(window // 16) :]
        data = data[at:]
    yield kept


def _contents(data: bytes, window: int) -> Iterator[str]:
    """Layers that decoded bytes hold: the bytes themselves, or what they unpack to."""
    for part in _unzipped(data, window) if _archive(data) else (data,):
        if _PRINTABLE.search(part):
            yield part.decode("utf-8", "replace")


def _unpacked(run: str) -> Iterator[tuple[bytes, int, int]]:
    """Bytes that a run may stand for, as hex and as base64, with their place in the run."""
    lines, at = [], 0
    for m in [*_BREAK.finditer(run), None]:
        end = m.start() if m else len(run.rstrip("="))
        lines.append((at, run[at:end]))
        at = m.end() if m else end
    # The line behind a block may be plain text, and lines may be runs of their own.
    choices = [lines] if len(lines) == 1 else [lines, *([lines[:-1]] if len(lines) > 2 else []), *([x] for x in lines)]
    for chosen in choices:
        body = "".join(part for _, part in chosen)
        if len(body) < 16:
            continue
        firsts = list(accumulate((len(part) for _, part in chosen), initial=0))
        last = len(run) if chosen[-1] is lines[-1] else chosen[-1][0] + len(chosen[-1][1])

        def place(i: int, chosen=chosen, firsts=firsts) -> int:
            line = bisect_right(firsts, i) - 1
            return chosen[line][0] + i - firsts[line]

        for m in _HEX.finditer(body):
            # A letter beside a hex run may be one of hex too, so both alignments are tried.
            for cut in {0, len(m[0]) % 2}:
                digits = m[0][cut : cut + len(m[0]) // 2 * 2]
                yield bytes.fromhex(digits), place(m.start() + cut), place(m.start() + cut + len(digits) - 1) + 1
        letters = body.translate({45: 43, 95: 47})
        known: set[int] = set()
        for start in [0, *(m.end() for m in re.finditer("[/+]", letters))]:
            if len(letters) - start < 16:
                break
            # Later starts of one alignment give the same bytes, but an archive has to begin at its start.
            if start % 4 not in known or _archive(base64.b64decode(letters[start : start + 4])):
                known.add(start % 4)
                whole, more = divmod(len(letters) - start, 4)
                taken = letters[start:] + "=" * (4 - more) if more > 1 else letters[start : start + 4 * whole]
                yield base64.b64decode(taken), place(start), last


def scan(text: str | None, window: int = WINDOW) -> dict:
    """Base spans, all spans in code points of the text, the number of layers, and runs not decoded."""
    text = text or ""
    base = base_spans(text)
    spans, seen, cut = set(base), set(), 0
    # (layer, place): place is the original span for a packed layer, or the map of an escape layer.
    work: list[tuple[str, tuple[int, int] | tuple[array, array] | None]] = [(text, None)]
    layers = 0
    while work:
        layer, place = work.pop()
        layers += 1

        def original(start: int, end: int, place=place) -> tuple[int, int]:
            if place is None:
                return start, end
            if isinstance(place[0], int):
                return place
            return place[0][start], place[1][end - 1]

        if place is not None:
            for start, kind, end in base_spans(layer):
                a, b = original(start, end)
                spans.add(Span(a, kind, b))
        found: list[tuple[bytes, tuple[int, int]]] = []
        # escapes: one new layer with all runs of the text replaced
        if "%" in layer or "\\" in layer or "&#" in layer:
            parts, starts, ends, at, changed = [], array("q"), array("q"), 0, False
            for m in ESCAPES.finditer(layer):
                plain = _unescape(m[0])
                if not plain:
                    if m[0][0] in "%\\" and m[0][1] != "u":
                        # Bytes that are no text: an archive perhaps, with its letters left as they are.
                        whole = _PERCENT.match(layer, m.start()) if m[0][0] == "%" else m
                        data = unquote_to_bytes(whole[0]) if m[0][0] == "%" else bytes.fromhex(m[0].replace("\\x", ""))
                        found.append((data, original(*whole.span())))
                    continue
                changed = True
                for lo, hi, piece in ((at, m.start(), layer[at : m.start()]), (m.start(), m.end(), plain)):
                    parts.append(piece)
                    if piece is plain:
                        a, b = original(lo, hi)
                        starts.extend([a] * len(piece))
                        ends.extend([b] * len(piece))
                    elif place is None:
                        starts.extend(range(lo, hi))
                        ends.extend(range(lo + 1, hi + 1))
                    elif isinstance(place[0], int):
                        starts.extend([place[0]] * len(piece))
                        ends.extend([place[1]] * len(piece))
                    else:
                        starts += place[0][lo:hi]
                        ends += place[1][lo:hi]
                at = m.end()
            if changed:
                rest = layer[at:]
                for lo in range(at, len(layer)):
                    a, b = original(lo, lo + 1)
                    starts.append(a)
                    ends.append(b)
                whole = "".join([*parts, rest])
                if _is_new(whole, seen):
                    work.append((whole, (starts, ends)))
        # packed runs: a layer each
        for m in PACKED.finditer(layer):
            found += [(data, original(m.start() + lo, m.start() + hi)) for data, lo, hi in _unpacked(m[0])]
        for data, span in found:
            try:
                for plain in _contents(data, window):
                    if _is_new(f"{span}\n{plain}", seen):
                        work.append((plain, span))
            except _Cut:
                cut += 1
    return {"base": base, "spans": sorted(spans), "layers": layers, "unscanned": cut}


def _is_new(content: str, seen: set[bytes]) -> bool:
    digest = hashlib.blake2b(content.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    if digest in seen:
        return False
    seen.add(digest)
    return True


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


RESULT = (
    "doc_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long,"
    " n_unscanned long"
)


def _scanner(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_unscanned")}
            for value in batch.column(1):
                found = scan(value.as_py(), window)
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(s.kind == kind for s in found["base"]))
                out["base_sha256"].append(hashlib.sha256(written(found["base"]).encode()).hexdigest())
                out["spans"].append(written(found["spans"]))
                out["n_layers"].append(found["layers"])
                out["n_unscanned"].append(found["unscanned"])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], ["doc_id", *out])

    return run


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document with counts and spans; narrow, nothing is shuffled."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(_scanner(window), RESULT.format(id=kind))
