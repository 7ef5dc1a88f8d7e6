"""Template residue, filler, error pages and notices in texts.

Texts are cut into segments (lines and sentences) and read once. Four kinds of
evidence exclude a document:

* Slots. Records of the same template are aligned at their constant words: names,
  numbers and markers are masked, and a masked position whose filler differs between
  records with the same words around it is a slot, and so is one in a segment whose
  constant ends come again around other fillings. A slot that keeps a marker, a default
  or a blank is unfilled. A marker that stands alike in all records with these words
  is part of the sentence: a text about markers.
* Pages. Templates of whole pages in place of content are induced: wordings that come
  again in several texts, mostly in texts that are hardly longer than the wording.
  Sentences of content come again too, but in texts of all lengths. The language and
  the words do not matter. Output of programs is known by its syntax as well.
* Filler. Words that keep company with dummy Latin all over the corpus; segments
  made of them; and repeated words or letters in place of text.
* Blank forms.

Every text is read whole; the corpus statistics cover all documents. Copies of a text are
one record of a template, but weigh in the share of pages among the documents of a wording.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.session import cut, spread

#: Markers of an unfilled slot: syntax of template languages, defaults and blanks (fixed values).
MARKER = re.compile(
    r"\{\{#.{0,60}?\}\}.{0,60}?\{\{/.{0,20}?\}\}|\{\{.*?\}\}|\{%.*?%\}|<%.*?%>|<!--.*?-->|\$\{[^}]*\}|\$\[[^\]]*\]|\{[\w .:|-]{1,40}\}|%%\w+%%|%[A-Z_]{3,}%|%[sd]\b|@@\w+@@|\$[A-Z_]{3,}\b(?!/)"
    r"|#[A-Z_]{3,}#|<<[^<>]{1,40}>>|<[A-Z][A-Z _]{2,40}>|&lt;[\w ]{1,40}&gt;|«[\w ]{1,40}»|\[\[[\w .-]{1,40}\]\]|\[[A-Za-z][\w :,.'-]{1,60}\](?:, ?\[[A-Za-z][\w :,.'-]{1,60}\])*|__[A-Z][A-Z_]*__|~\w{3,30}~"
    r"|\bNULL\b|\bundefined\b|\bNaN\b(?: (?:mi|km|ft|m)\b)?|\?{4,}|\bX{2,}(?:/X{2,})+|\b[dm]{2}/[dm]{2}/y{2,4}\b|_{4,}(?: ?\([\w ]+\))?|\((?:enter|fill in|insert|add|type)\b[^)]{0,60}\)"
    r"|\b(?:COMPANY|SITE|CITY|STATE|SHIPPER|YOUR) NAME\b|\b(?:[Yy]our|[Aa]dd|[Ii]nsert|[Ee]nter|[Tt]ype) [\w ]{1,40}\bhere\b|\b[Rr]eplace this text(?: with (?:[\w ]{1,40}?(?=[.,;]|$)|(?:the|an?|your) \w+(?: \w+)?))?"
)
#: Output of programs in place of content (fixed values: syntax of stack traces, logs, responses and scripts).
SYNTAX = re.compile(
    r"traceback \(most recent call last\)|\b\w+(?:error|exception)\b(?::|$)|\bat [\w.$]+\([\w.]+:\d+\)|^goroutine \d+|^panic:|segmentation fault|\bhttp(?:/\d\.\d| error) [45]\d\d\b"
    r"|^(?:warning|notice|fatal(?: error)?|parse error|runtime error|error|exception) ?:|\[(?:error|fatal|critical)\]|\bon line \d+$|</?(?:error|noscript)>|\"(?:error|status)\": ?[{\"]|document\.write\(|window\.__\w+ ?=",
    re.I,
)
_SYNTAX_PARTS = ("traceback", "error", "exception", "goroutine", "panic", "fault", "warning", "notice", "fatal", "on line", "<noscript", "status", "window")
#: A page template: so many words at the start or end of a segment, or all of one without names and numbers, in at
#: least so many distinct texts; and the least share of them, at the lower end of its error, that are no longer than so
#: many characters: for a part, a whole segment, and one where a word has a capital and may be a name.
ANCHOR, PAGE_TEXTS, PAGE_CHARS = 4, 3, 250
PART_SHARE, WHOLE_SHARE, NAMED_SHARE = 0.4, 0.3, 0.6
#: The same as a multiple of the share of short texts over all wordings.
PAGE_LIFT = 2.0
#: A line of links between separators.
_LINKS = re.compile(r"\S\s*[|>/»·]\s.*\s[|>/»·]\s*\S")
#: Words before a message that make it a quotation (fixed values).
_MENTION = re.compile(r"[\"“«]|\b(?:says?|said|notes?|noted|reads?|heading|printed|painted|sign|bulletin|letters?|train|words?|titled|called|quotes?|quoted|reported|means?)\b", re.I)
#: Letters or keys in place of words.
DUMMY = re.compile(r"\b([a-z])\1{2,}(?: ([a-z])\2{2,}){2,}|\b(?:asdf|qwer|lkj|zxcv|hjkl)\w*(?: \w+){0,2} (?:asdf|qwer|lkj|zxcv|hjkl)", re.I)
_REPEAT = re.compile(r"\b(\w{2,})(?:[ .,]+\1\b){3,}", re.I)
_KEYS = re.compile(r"asdf|qwer|lkj|zxcv|hjkl|([a-z])\1\1")
#: Words of dummy Latin that start the filler vocabulary (fixed values).
SEEDS = frozenset("lorem ipsum dolor consectetur adipiscing eiusmod incididunt".split())
#: A word is filler if at least this share of its segments are mostly filler, a segment if this share of its words is.
WORD_SHARE, SEGMENT_SHARE, LEAST_WORDS, LIFT = 0.6, 0.8, 5, 10.0
#: A form is unfilled if at least so many of its fields and this share are blank.
BLANK_FIELDS, BLANK_SHARE = 3, 0.7
_FIELD = re.compile(r"^\s*[A-Z][\w /-]{1,30}\s?[:=]\s*(.*?)\s*$")
_EMPTY = re.compile(r"^(?:\(?(?:blank|empty|none given|to be completed|fill in)\)?|[.…_-]*|n/?a|tbd|\?+)$", re.I)
_LEAD = re.compile(r"^(?:\d\d-\d\d \d\d:\d\d\s+|[-*•>|]\s+)+")
_SPLIT = re.compile(r"\n+|(?<=[.!?])\s+(?=[^a-zà-ÿ])")
_NAME = re.compile(r"[A-ZÀ-Þ](?:[\w'.-]*\w)?(?:\s+(?:&\s+|and\s+)?[A-ZÀ-Þ](?:[\w'.-]*\w)?)*|\d(?:[\d.,:/-]*\d)?")
_WORD = re.compile(r"[^\W\d_]+")

#: What every marker has a part of: a quick look before the pattern.
_MARK_PARTS = re.compile(r"[{<$%@#«\[~&?_]|NULL|undefined|NaN|XX|[dm]{2}/|\((?:enter|fill|insert|add|type)| NAME|here\b|eplace this")
_BUSY = re.compile(r"[A-ZÀ-Þ\d]")
_CAPITAL, _DIGIT, _NUMBER = re.compile(r"(?<!\S)[A-ZÀ-Þ]"), re.compile(r"\d"), re.compile(r"\S*\d\S*")
_FRAME = re.compile(r":\d+\)")
_CLOSING = ".,;:!?)\"'”»"

_OUT = "doc_id long, copy long, kind string, context string, value string, marker boolean, segment int, words array<string>"


def segments(text: str) -> list[str]:
    """Lines and sentences without list marks, time stamps and outer blanks."""
    return [s for s in (_LEAD.sub("", x.strip()) for x in _SPLIT.split(text)) if s]


def skeleton(segment: str) -> list[tuple[str, str, bool]]:
    """The maskable positions of a segment with markers: (context, filler, whether it is a marker).

    The context is the two words on either side, with names and numbers masked as
    well; positions of the same context are aligned with each other.
    """
    spans = [(m.start(), m.end(), True) for m in MARKER.finditer(segment)]
    free, at = [], 0
    for a, b, _ in [*spans, (len(segment), len(segment), True)]:
        free += [(at + m.start(), at + m.end(), False) for m in _NAME.finditer(segment[at:a])]
        at = b
    spans = sorted(spans + free)
    pieces, at = [], 0
    for a, b, _ in spans:
        pieces.append(segment[at:a].lower().split())
        at = b
    pieces.append(segment[at:].lower().split())
    return [(" § ".join(_beside(pieces, k)), segment[a:b], marker) for k, (a, b, marker) in enumerate(spans)]


def _beside(pieces: list[list[str]], k: int) -> tuple[str, str]:
    """The two words before and after the masked position ``k`` between ``pieces``."""
    left = ["§" if k else "^", *pieces[k]][-2:]
    right = [*pieces[k + 1], "§" if k + 2 < len(pieces) else "$"][:2]
    return " ".join(left), " ".join(right)


def _is_dummy(segment: str, words: list[str], keys: bool) -> bool:
    """Words or letters in place of text; the patterns look only where words come again or the text has runs of letters or keys."""
    again = len(words) >= 4 and len(set(words)) <= len(words) - 3
    return (again and _REPEAT.search(segment) is not None) or (keys and DUMMY.search(segment) is not None)


def anchors(segment: str, words: list[str]) -> list[str]:
    """The first and last of a segment's words, or all of a short one, by which copies of its template are known.

    Numbers are masked; a wording with a capital after the first word is marked, for it may have a
    name. Wordings without two words that are no number, fields with a short value or none, and
    lines of links have none.
    """
    if (":" in segment or "=" in segment) and (m := _FIELD.match(segment)) and len(m[1].split()) < ANCHOR:
        return []
    if any(c in segment for c in "|/>·»") and _LINKS.search(segment):
        return []
    upper = segment.isupper()
    if len(words) <= ANCHOR:
        parts = [("=", 1, " ".join(words))]
    else:
        parts = [("^", 1, " ".join(words[:ANCHOR])), ("$", 0, " ".join(words[-ANCHOR:]))]
        if upper or not _BUSY.search(segment, 1):
            parts.append(("=", 1, segment))
    out = []
    for tag, start, text in parts:
        named = not upper and _CAPITAL.search(text, start) is not None
        shown = text.lower()
        if _DIGIT.search(shown):
            shown = _NUMBER.sub("#", shown)
            if len(shown) - shown.count("#") * 2 < 3 or sum(w != "#" for w in shown.split()) < min(2, len(words)):
                continue
        out.append(tag + ("§" if named else "") + shown)
    return out


def is_page(text: str) -> bool:
    """True for a text no longer than a notice that is no filled form."""
    return len(text) <= PAGE_CHARS and sum(1 for line in text.split("\n") if (m := _FIELD.match(line)) and not _EMPTY.match(m[1])) < 2


def form_is_blank(text: str) -> bool:
    """True if the text has a form most of whose fields are blank."""
    fields = [m[1] for line in text.split("\n") if (m := _FIELD.match(line))]
    blank = sum(1 for f in fields if _EMPTY.match(f))
    run = best = 0
    for line in text.split("\n"):
        m = _FIELD.match(line)
        run = run + 1 if m and _EMPTY.match(m[1]) else 0
        best = max(best, run)
    return best >= BLANK_FIELDS and (blank >= BLANK_SHARE * len(fields) or best >= 4)


def _evidence(docs: DataFrame) -> DataFrame:
    """Rows of evidence of the documents (doc_id, text), from one reading of the texts.

    form, syntax and dummy stand for themselves. slot: a masked position of a segment with
    a marker. end: a wording at an end of such a segment without name or marker. anchor: a
    template by its wording, ``marker`` telling whether the text is a page and ``segment``
    whether the segment has a marker. latin: the words of a segment without names and numbers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for doc, copy, text in zip(pdf["doc_id"], pdf["copy"], pdf["text"], strict=True):
                if form_is_blank(text):
                    out.append((doc, copy, "form", "", "", False, 0, None))
                page = is_page(text)
                low_text = text.lower()
                program = any(p in low_text for p in _SYNTAX_PARTS) or _FRAME.search(text) is not None
                keys = _KEYS.search(low_text) is not None
                marked = _MARK_PARTS.search(text) is not None
                wordings: set[str] = set()
                marks: set[str] = set()
                for k, s in enumerate(segments(text)):
                    words = s.split()
                    ends = anchors(s, words)
                    if program and (m := SYNTAX.search(s)) and not _MENTION.search(s[: m.start()]):
                        out.append((doc, copy, "syntax", "", "", False, k, None))
                    if marked and _MARK_PARTS.search(s) and MARKER.search(s):
                        out += [(doc, copy, "slot", context, f, mark, k, None) for context, f, mark in skeleton(s)]
                        out += [(doc, copy, "end", x, "", False, k, None) for x in ends if "§" not in x and not MARKER.search(x, 1)]
                        marks.update(ends)
                    else:
                        wordings.update(ends)
                    plain = _is_plain(s)
                    if plain or keys or len({w.lower() for w in words}) < len(words) - 2:
                        letters = _WORD.findall(s.lower())
                        if _is_dummy(s, letters, keys):
                            out.append((doc, copy, "dummy", "", "", False, k, None))
                        if plain and len(letters) >= LEAST_WORDS:
                            out.append((doc, copy, "latin", "", "", False, k, letters))
                # wordings of segments with a marker (1) are no filled records
                out += [(doc, copy, "anchor", x, "", page, 0, None) for x in wordings]
                out += [(doc, copy, "anchor", x, "", page, 1, None) for x in marks - wordings]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    rows = docs.select("doc_id", F.xxhash64("text").alias("copy"), "text")
    found = spread(rows).mapInPandas(run, _OUT)
    return found.withColumns({"named": F.contains("context", F.lit("§")), "head": F.left("context", F.lit(1)), "context": F.xxhash64("context"), "value": F.xxhash64("value")})


def _is_plain(segment: str) -> bool:
    """No name or number within: no digit, and no capital after the first word unless all are capitals."""
    if segment.isupper():
        return not any(c.isdigit() for c in segment)
    first = _WORD.search(segment)
    return first is not None and _BUSY.search(segment, first.start() + 1) is None


def _open_slots(evidence: DataFrame) -> DataFrame:
    """Documents with an unfilled slot."""
    slots = evidence.where("kind = 'slot'")
    # a position is a slot if its filler differs between records of the same context
    fillers = slots.groupBy("context").agg(F.count_distinct("value").alias("values"), F.count_distinct("copy").alias("records"))
    several = slots.groupBy("doc_id", "segment").agg(F.count_if("marker").alias("markers"))
    weighed = slots.where("marker").join(fillers, "context").join(several, ["doc_id", "segment"])
    # a context seen in one record cannot be aligned: two markers in the segment speak for a
    # template; the same markers in several records, and filled in none, are a text about markers
    differ = weighed.where((F.col("values") > 1) | ((F.col("records") == 1) & (F.col("markers") > 1))).select("doc_id")
    # and a segment is a record of a template whose filled records have all its constant ends
    ends = evidence.where("kind = 'end'").select("doc_id", "segment", "context")
    filled = evidence.where("kind = 'anchor' and segment = 0").select("context").distinct().withColumn("filled", F.lit(True))
    whole = ends.join(filled, "context", "left").groupBy("doc_id", "segment").agg(F.every(F.coalesce("filled", F.lit(False))).alias("filled"))
    return differ.unionByName(whole.where("filled").select("doc_id"))


def _pages(evidence: DataFrame) -> DataFrame:
    """Documents with a wording of an induced page template."""
    wordings = evidence.where("kind = 'anchor'").select("doc_id", "copy", "context", F.col("marker").alias("page"), "named", "head")
    once = wordings.groupBy("context", "copy", "page", "named", "head").agg(F.count(F.lit(1)).alias("docs"))
    # of fixed pages there are only so many distinct texts, while texts of content that have their wording go on
    # growing with the corpus: so the share of pages is one of documents, and its error and the least number of
    # records are those of distinct texts, which copies make no surer
    shown = F.sum(F.when(F.col("page"), F.col("docs")).otherwise(0))
    seen = once.groupBy("context").agg(F.count(F.lit(1)).alias("texts"), (shown / F.sum("docs")).alias("share"), F.max("named").alias("named"), F.max(F.col("head") == "=").alias("whole"))
    # a wording seen in few texts must stand in nearly none but pages
    seen = seen.where(F.col("texts") >= PAGE_TEXTS).withColumn("p", (F.col("share") * F.col("texts") + 0.5) / (F.col("texts") + 1))
    least = F.when(F.col("named"), NAMED_SHARE).when(F.col("whole"), WHOLE_SHARE).otherwise(PART_SHARE)
    # where most texts are short anyway, a short text is no evidence
    usual = once.agg(F.coalesce(shown / F.sum("docs"), F.lit(0.0)).alias("usual"))
    seen = seen.join(F.broadcast(usual)).withColumn("least", F.greatest(least, PAGE_LIFT * F.col("usual")))  # one row
    seen = seen.where(F.col("p") - 2 * F.sqrt(F.col("p") * (1 - F.col("p")) / (F.col("texts") + 1)) >= F.col("least"))
    # within a longer text only a segment that begins with the wording has it: others may quote it
    return wordings.where("page or head <> '$'").join(seen.select("context"), "context", "left_semi").select("doc_id")


def _filler_docs(evidence: DataFrame) -> DataFrame:
    """Documents with a segment of dummy Latin; its vocabulary is learnt from the whole corpus."""
    said = evidence.where("kind = 'latin'").select("doc_id", F.array_sort(F.array_distinct("words")).alias("shape")).withColumn("sid", F.xxhash64("shape"))
    parts = cut(said.groupBy("sid").agg(F.first("shape").alias("shape")))
    words = parts.select("sid", F.explode("shape").alias("w"))
    seeds = evidence.sparkSession.createDataFrame([(w,) for w in sorted(SEEDS)], "w string")
    vocabulary = seeds
    for k in range(3):
        hits = words.join(vocabulary, "w").groupBy("sid").agg(F.count(F.lit(1)).alias("k"))
        share = parts.select("sid", F.size("shape").alias("of")).join(hits, "sid", "left").select("sid", (F.coalesce("k", F.lit(0)) / F.col("of")).alias("share"))
        # the first round asks which words keep company with a seed, far more often than words
        # do by chance; the later ones which words live in segments that are mostly filler
        suspect = share.select("sid", (F.col("share") > 0 if k == 0 else F.col("share") >= 0.5).cast("int").alias("suspect"))
        base = suspect.agg(F.avg("suspect").alias("base"))
        by_word = words.join(suspect, "sid").groupBy("w").agg(F.avg("suspect").alias("p"), F.count(F.lit(1)).alias("n"))
        by_word = by_word.join(F.broadcast(base)).where(F.col("n") >= 3)  # one row
        kept = by_word.where((F.col("p") >= LIFT * F.col("base")) & (F.col("p") >= 0.1)) if k == 0 else by_word.where(F.col("p") >= WORD_SHARE)
        vocabulary = cut(kept.select("w").union(seeds).distinct())
    hits = words.join(vocabulary, "w").groupBy("sid").agg(F.count(F.lit(1)).alias("k"))
    bad = parts.join(hits, "sid").where(F.col("k") >= SEGMENT_SHARE * F.size("shape")).select("sid")
    return said.select("doc_id", "sid").join(bad, "sid", "left_semi").select("doc_id")


def residue_evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, kind) of all documents to exclude, with the kinds of evidence: form, syntax, page, dummy, slot, filler.

    ``docs`` has doc_id and text. Null and blank texts are no case. Copies of a text
    share the result and are one record of a template. Other columns are ignored; an
    empty table gives an empty result.
    """
    evidence = cut(_evidence(docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length(F.trim("text")) > 0))))
    found = evidence.where("kind in ('form', 'syntax', 'dummy')").select("doc_id", "kind")
    for kind, rows in (("slot", _open_slots(evidence)), ("page", _pages(evidence)), ("filler", _filler_docs(evidence))):
        found = found.unionByName(rows.select("doc_id", F.lit(kind).alias("kind")))
    return found.distinct()
