"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over each whole text:
at-signs, plus signs, digits, URL schemes and identifier cues.  A small
deterministic parser per kind expands an anchor to its boundaries and
validates it.  The base kinds (email, ip, card, phone) equal the leftmost,
non-overlapping matches of these patterns, failing matches dropped:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), each part at most 255
    card   [0-9]([\\x20-]?[0-9])+, 13 to 19 digits, Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9], 9 to 15 digits

Two kinds are added by the method: `address` (scheme://user@host, a URL that
carries a login) and `account` (an identifier after a cue such as `iban:` or
`token =`).  Null and empty texts have no spans.  Offsets are code points,
end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, of_worker

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "account", "acct", "passport", "ssn", "token", "api_key", "apikey", "password")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_ACCOUNT = _ALNUM | frozenset("-_")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "@"), ("+", "+"), *((d, "d") for d in "0123456789")):
        found.add_word(sign, (kind, 1))
    for kind, words in (("s", SCHEMES), ("c", CUES)):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at `at`."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _domain(text: str, at: int) -> int:
    """End of label(.label)+ at `at`, or -1."""
    end = _run(text, at, _LABEL)
    if end == at:
        return -1
    dotted = False
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end, dotted = _run(text, end + 1, _LABEL), True
    return end if dotted else -1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def find(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text, in the order of KINDS, then by start."""
    if not text:
        return []
    n = len(text)
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = phone_end = card_end = ip_end = account_end = 0
    for last, (sign, width) in anchors.iter(text):
        at = last - width + 1
        if sign == "d":
            if at >= card_end:
                card_end = at + 1
                while card_end < n:
                    step = card_end + (text[card_end] in " -")
                    if step < n and text[step] in _DIGITS:
                        card_end = step + 1
                    else:
                        break
                digits = "".join(c for c in text[at:card_end] if c in _DIGITS)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append((at, card_end))
            if at >= ip_end:
                parts, end = [], at
                while end < n and text[end] in _DIGITS:
                    stop = _run(text, end, _DIGITS)
                    parts.append((end, stop))
                    ip_end = stop
                    if stop < n and text[stop] == ".":
                        end = stop + 1
                    else:
                        break
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k:k + 4]
                    if all(b - a < 4 or not text[a:b].lstrip("0")[3:] for a, b in four) and all(
                            int(text[a:b].lstrip("0")[:3] or 0) <= 255 for a, b in four):
                        out["ip"].append((four[0][0], four[3][1]))
        elif sign == "@":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (end := _domain(text, at + 1)) > 0:
                out["email"].append((start, end))
                email_end = end
        elif sign == "+":
            if at >= phone_end and at + 1 < n and text[at + 1] in _DIGITS:
                end = _run(text, at + 2, _PHONE)
                while end > at + 3 and text[end - 1] not in _DIGITS:
                    end -= 1
                if end > at + 3:
                    phone_end = end
                    if 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                        out["phone"].append((at, end))
        elif sign == "s":
            login = _run(text, last + 1, _LOCAL | frozenset(":"))
            if login > last + 1 and login < n and text[login] == "@":
                end = _domain(text, login + 1)
                if end > 0:
                    out["address"].append((at, end))
        elif at >= account_end and (at == 0 or text[at - 1] not in _ALNUM):
            begin = _run(text, last + 1, frozenset(" :=#\"'"))
            if begin > last + 1:
                end = _run(text, begin, _ACCOUNT)
                if end - begin >= 8 and sum(c in _DIGITS for c in text[begin:end]) >= 4:
                    out["account"].append((begin, end))
                    account_end = end
    return [(kind, a, b) for kind in KINDS for a, b in sorted(out[kind])]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = of_worker("pii", automaton)
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t, anchors)]
                 for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, _SPANS)], ["doc_id", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind, start, end>>."""
    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of the base spans and all spans as text."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                 s["end"].cast("string"))), ",")
    count = lambda kind: F.size(
        F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(text: str | None, spans) -> str | None:
    """Replace each span by [kind]; overlapping spans are merged under the first one's kind."""
    if text is None:
        return None
    parts, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            parts += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join(parts) + text[done:]

