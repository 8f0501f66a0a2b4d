"""Personal data in texts: fixed patterns, and bootstrapped extraction by context.

Spans of the fixed patterns (email, ip, card, phone) are the seeds. The words around them
are lexical patterns, and so are those around other strings that look like identifiers: such with "@" or "(at)",
runs of groups of digits, and strings between white space that hold digits.
Patterns and the strings they surround form a graph, which Spark scores in turns: a pattern is
as trustworthy for a kind as the strings it surrounds, a string as the patterns around it. Strings found
back further patterns in the next turn.
Strings whose score passes the threshold become spans of that kind, beside the seeds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .texts import blocks, strings

KINDS = ["email", "ip", "card", "phone"]

#: The patterns. A digit before an address or number is part of it, so the look-behinds change no match.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEEN = re.compile(r"[0-9@]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\S+")
_MAYBE = re.compile(r"[0-9@]|[(\[{<] ?at ?[)\]}>]", re.IGNORECASE)
_AT = re.compile(r" ?[(\[{<] ?at ?[)\]}>] ?", re.IGNORECASE)
_RUN = re.compile(r"(?<![0-9])[0-9]++(?:[\x20().-]{1,3}[0-9]++)+")
_SPACE = re.compile(r"\s")
_EDGE = "()[]{}<>\"'`,;:!?.*#$%&|=_-/\\~^"


@dataclass(frozen=True)
class Settings:
    """digits: least digits of a string without "@" or "(at)" that may be an identifier; longest: most characters of it.

    longest_at: most characters of one with "@" or "(at)", as of an address.

    around: characters before and after a span in which context words are looked for.
    rounds: most turns of scoring. support: least distinct seeds or strings found of a trusted pattern.
    threshold: least score of a string that becomes a span.
    """

    digits: int = 5
    longest: int = 64
    longest_at: int = 254
    around: int = 80
    rounds: int = 3
    support: int = 3
    threshold: float = 0.8


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from each @ outwards, so that long runs of letters cost nothing."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in that order."""
    if not _SEEN.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_byte(x) for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


def _shape(value: str) -> str:
    if "@" in value or _AT.search(value):
        return "at"
    if any(c.isalpha() for c in value):
        return "mixed"
    return "dotted" if value.count(".") >= 3 else "digits"


def _words(text: str) -> list[str]:
    return [re.sub("[0-9]", "0", w.strip(_EDGE).lower()) for w in text.split()]


def patterns(text: str, start: int, end: int, around: int) -> list[str]:
    """The lexical patterns that surround a span: the words beside it, with the shape of what it holds."""
    before = ["", ""] + _words(text[max(0, start - around) : start])[-2:]
    after = (_words(text[end : end + around]) or [""])[0]
    shape = _shape(text[start:end])
    return [f"{shape}|{before[-2]} {before[-1]}|", f"{shape}|{before[-1]}|{after}", f"{shape}|{before[-1]}|", f"{shape}||{after}"]


def _marked(text: str, longest: int) -> Iterator[tuple[int, int]]:
    """Strings around each "(at)", found outwards from it."""
    for m in _AT.finditer(text):
        start, end = m.start(), m.end()
        while start > 0 and m.start() - start <= longest and not _SPACE.match(text, start - 1):
            start -= 1
        while end < len(text) and end - m.end() <= longest and not _SPACE.match(text, end):
            end += 1
        if start < m.start() and end > m.end():
            yield start, end


def candidates(text: str, taken: list[tuple[int, int, int]], settings: Settings) -> list[tuple[int, int]]:
    """Strings that may be identifiers by their shape, less the punctuation at their ends, and that hold no span taken.

    These are strings between white space and around "(at)", and runs of groups of digits. They may lie within each other.
    """
    out = set()
    spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text) if _SEEN.search(m[0])]
    for start, end in [*spans, *_marked(text, settings.longest_at)]:
        whole = text[start:end]
        value = whole.strip(_EDGE)
        start += len(whole) - len(whole.lstrip(_EDGE))
        at = _AT.search(value) or value.find("@", 1, len(value) - 1) > 0
        if at and len(value) <= settings.longest_at or sum("0" <= c <= "9" for c in value) >= settings.digits and len(value) <= settings.longest:
            out.add((start, start + len(value)))
    for m in _RUN.finditer(text):
        start = m.start() - (m.start() > 0 and text[m.start() - 1] == "(" and ")" in m[0])
        if len(_NO_DIGIT.sub("", m[0])) >= settings.digits and m.end() - start <= settings.longest:
            out.add((start, m.end()))
    return sorted((start, end) for start, end in out if not any(s < end and start < e for s, _, e in taken))


def found_spans(rows: DataFrame, settings: Settings) -> DataFrame:
    """rows (id, text) as (row, id, base, strings): spans of the fixed patterns, and all strings with their patterns.

    base: array of (start, kind, end). strings: array of (start, end, kind, value, patterns); kind is -1 for
    those that no fixed pattern matches.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            base, others = [], []
            for text in strings(block):
                taken = base_spans(text)
                spans = [(s, e, k) for s, k, e in taken]
                if _MAYBE.search(text):
                    spans += [(s, e, -1) for s, e in candidates(text, taken, settings)]
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in taken])
                others.append(
                    [{"start": s, "end": e, "kind": k, "value": text[s:e].lower(), "patterns": patterns(text, s, e, settings.around)} for s, e, k in spans]
                )
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(base, _BASE), pa.array(others, _STRINGS)], ["id", "base", "strings"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, base array<struct<start:long,kind:int,end:long>>, strings array<struct<start:long,end:long,kind:int,value:string,patterns:array<string>>>"
    return rows.select("id", "text").mapInArrow(scan, schema)


_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_STRINGS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
)


def scored_strings(graph: DataFrame, settings: Settings) -> DataFrame:
    """(value, kind, score) of the strings that the patterns make identifiers.

    graph: distinct (pattern, value, kind), kind -1 for strings of unknown kind. A pattern's score for
    a kind is the sum of its strings' scores over their number plus one, if enough seeds of the kind and
    strings that pass the threshold support it; this is found anew in each turn, until no string is added or the turns end. A string's score is 1 - the product of (1 - score) over its patterns.
    """
    seeds = graph.filter("kind >= 0").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    edges = written(graph.select("pattern", "value").distinct(), "edges")
    sizes = written(edges.groupBy("pattern").agg(F.count("*").alias("size")), "sizes")
    unknown = graph.filter("kind < 0").select("pattern", "value").distinct()
    scores, found, before = seeds, None, -1
    for _ in range(settings.rounds):
        backing = F.count(F.when(F.col("score") >= settings.threshold, 1)).alias("backing")
        weights = edges.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("weight"), backing)
        rated = weights.filter(F.col("backing") >= settings.support).join(sizes, "pattern")
        rated = rated.select("pattern", "kind", (F.col("weight") / (F.col("size") + 1)).alias("rate"))
        found = unknown.join(rated, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("rate"))))).alias("score"))
        found = written(found, "scores")
        scores = seeds.union(found.select("value", "kind", "score")).groupBy("value", "kind").agg(F.max("score").alias("score"))
        passed = found.filter(F.col("score") >= settings.threshold).count()
        if passed == before:
            break
        before = passed
    best = F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best")
    found = found.groupBy("value").agg(best).select("value", (-F.col("best.kind")).alias("kind"), F.col("best.score").alias("score"))
    return found.filter(F.col("score") >= settings.threshold)


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def personal_data(documents: DataFrame, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every document.

    base_sha256 is the SHA-256 of kind:start:end of the fixed patterns' spans, spans lists all
    spans in that form, both by start, then kind as in KINDS. Offsets count code points. A null text is an empty
    one. Rows that repeat, or have no id, are looked through each. Other columns are not read. An empty table gives no rows.
    """
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    seen = written(found_spans(rows, settings).withColumn("row", F.monotonically_increasing_id()), "spans")
    every = seen.select("row", F.explode("strings").alias("s")).select("row", "s.*")
    graph = written(every.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct(), "graph")
    known = scored_strings(graph, settings).select("value", F.col("kind").alias("as"))
    added = every.filter("kind < 0").join(known, "value")
    added = added.groupBy("row").agg(F.collect_list(F.struct("start", F.col("as").alias("kind"), "end")).alias("added"))
    out = seen.join(added, "row", "left").withColumn("added", F.coalesce("added", F.expr("cast(array() as array<struct<start:long,kind:int,end:long>>)")))
    # Of added spans within each other the longest stays.
    within = lambda s, t: (t["start"] <= s["start"]) & (t["end"] >= s["end"]) & (t["end"] - t["start"] > s["end"] - s["start"])
    out = out.withColumn("added", F.filter("added", lambda s: ~F.exists("added", lambda t: within(s, t))))
    out = out.withColumn("all", F.array_sort(F.concat("base", "added")))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select(F.col("id").alias(id), *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("all").alias("spans"), F.size("added").cast("long").alias("n_added"))
