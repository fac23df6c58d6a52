"""Personal data: fixed rules, and identifiers that stand where known ones stand.

The rules find e-mail addresses, IP addresses, card and phone numbers. These seeds
induce lexical patterns, the two words before them. Other tokens that look like
identifiers stand after patterns too, which makes a graph of patterns and
instances. Rounds of joins and sums score it: a pattern by the share of all its
occurrences in the corpus that known instances follow, an instance by the patterns
it follows. Identifiers after accepted patterns are added to the seeds' spans.

The graph is grouped before it is shuffled and scored in Spark. Only patterns that
the rounds cannot reach from known instances are left out of it. Up to ``IN_TASK``
patterns are sent to the tasks; more are joined, with the same result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, unused_name, written

KINDS = ("email", "ip", "card", "phone")

# The rules of the four kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# What may be an identifier without fitting a rule: groups of digits, or one word
# with digits in it or an at sign.
_DIGITS = re.compile(r"\(?[0-9](?:[().\x20-]*+[0-9])*+")
_TOKEN = re.compile(r"[^\s,;\"'<>()\[\]{}]++")
_WORD = re.compile(r"\S++")
_ANY = re.compile(r"[0-9@]")

IN_TASK = 100_000
MIN_INSTANCES = 3
MIN_SCORE = 0.5
ROUNDS = 2


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        if i % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, at sign and dotted domain, found from the at signs."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL_LETTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            yield start, past
        at = text.find("@", max(at + 1, past))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind, then start."""
    if not _ANY.search(text):
        return []
    spans = [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((3, *m.span()))
    return spans


def candidate_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans that look like identifiers and touch no span of ``taken``; none overlap."""
    if not _ANY.search(text):
        return []
    found = []
    for m in _DIGITS.finditer(text):
        if sum(c.isdigit() for c in m[0]) >= 7:
            found.append(m.span())
    for m in _TOKEN.finditer(text):
        if not _ANY.search(m[0]):
            continue
        token = m[0].rstrip(".:!?")
        digits = sum(c.isdigit() for c in token)
        if len(token) >= 8 and (digits >= 4 or "@" in token.strip("@")):
            found.append((m.start(), m.start() + len(token)))
    busy = sorted((s, e) for _, s, e in taken)
    out, last, i = [], 0, 0
    for start, end in sorted(found, key=lambda x: (x[0], -x[1])):
        while i < len(busy) and busy[i][1] <= start:
            i += 1
        if start >= last and not any(s < end and e > start for s, e in busy[max(0, i - 1):i + 2]):
            out.append((start, end))
            last = end
    return out


class Words:
    """The words of a text, found when the first is asked for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.ends: list[int] | None = None

    def pattern_before(self, start: int) -> str | None:
        """The two words before a place, lower-cased, if the place follows white space."""
        if not start or not self.text[start - 1].isspace():
            return None
        if self.ends is None:
            self.ends = [m.end() for m in _WORD.finditer(self.text)]
        at = bisect_right(self.ends, start)
        if at < 2:
            return None
        before = self.ends[at - 3] if at > 2 else 0
        return " ".join(self.text[before:self.ends[at - 1]].lower().split())


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_record(batches):
        seen: Counter = Counter()
        for text in batch.column(0).to_pylist():
            base = base_spans(text or "")
            spans = [(KINDS[k], s, e) for k, s, e in base]
            spans += [("", s, e) for s, e in candidate_spans(text or "", base)]
            words = Words(text or "")
            for kind, s, e in spans:
                pattern = words.pattern_before(s)
                if pattern:
                    seen[pattern, text[s:e].lower(), kind] += 1
        if seen:
            patterns, instances, kinds = zip(*seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(patterns), pa.array(instances), pa.array(kinds), pa.array(list(seen.values()), pa.int64())],
                names=["pattern", "instance", "kind", "n"])


def _pairs(wanted: frozenset[tuple[str, str]] | None):
    """Counts of word pairs with a word behind them: of the wanted ones, or of all."""

    def grouped(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([" ".join(p) for p in seen]), pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in by_record(batches):
            for text in batch.column(0).to_pylist():
                words = text.lower().split() if text else []
                pairs = zip(words, words[1:-1])
                seen.update(pairs if wanted is None else (p for p in pairs if p in wanted))
                if len(seen) > IN_TASK:
                    yield grouped(seen)
                    seen.clear()
        if seen:
            yield grouped(seen)

    return run


def _reached(edges: DataFrame, kinds: DataFrame, rounds: int, min_instances: int) -> DataFrame:
    """Patterns that may be accepted in one of the rounds, whatever their scores.

    A round accepts a pattern only for ``min_instances`` different known instances:
    seeds, or such that follow a pattern of the round before.
    """
    seeds = kinds.where("seed <> ''").select("instance")
    linked, patterns = seeds, None
    for _ in range(rounds):
        patterns = written(
            edges.join(linked, "instance", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
            .where(F.col("instances") >= min_instances).select("pattern"), "reached-patterns")
        linked = seeds.unionByName(edges.join(patterns, "pattern", "left_semi").select("instance")).distinct()
    return patterns


def accepted_patterns(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, min_score: float = MIN_SCORE,
                      min_instances: int = MIN_INSTANCES, in_task: int = IN_TASK) -> DataFrame:
    """(pattern, as): accepted patterns and the kind of their seeds, from all texts.

    A pattern needs ``min_instances`` different known instances. Its score is the sum
    of its occurrences before known instances, weighted by confidence, over all its
    occurrences in the corpus. Equal weights of kinds go to the first kind.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    edges = written(
        texts.mapInArrow(_edges, "pattern string, instance string, kind string, n bigint")
        .groupBy("pattern", "instance").agg(F.sum("n").alias("n"), F.max("kind").alias("kind")), "pattern-graph")
    kinds = written(edges.groupBy("instance").agg(F.max("kind").alias("seed")), "instances")
    reached = _reached(edges, kinds, rounds, min_instances)
    few = [r["pattern"] for r in reached.limit(in_task + 1).collect()]
    if not few:
        return reached.select("pattern", F.lit("").alias("as"))
    wanted = frozenset(tuple(p.split(" ", 1)) for p in few) if len(few) <= in_task else None
    totals = written(
        texts.mapInArrow(_pairs(wanted), "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("total"))
        .join(reached, "pattern", "left_semi"), "pattern-totals")
    graph = written(edges.drop("kind").join(totals, "pattern").join(kinds, "instance"), "scored-graph")
    known = graph.where("seed <> ''").select("instance", F.col("seed").alias("as"), F.lit(1.0).alias("belief")).distinct()
    seeds, accepted = known, None
    for _ in range(rounds):
        sums = [F.sum(F.when(F.col("as") == k, F.col("n") * F.col("belief")).otherwise(0)).alias(k) for k in KINDS]
        scored = graph.join(known, "instance").groupBy("pattern", "total").agg(
            *sums, F.count_distinct("instance").alias("instances"))
        best = F.greatest(*KINDS)
        kind = F.coalesce(*[F.when(F.col(k) == best, F.lit(k)) for k in KINDS])
        accepted = written(
            scored.select("pattern", kind.alias("as"), "instances",
                          F.least(F.lit(1.0), sum((F.col(k) for k in KINDS), F.lit(0)) / F.col("total")).alias("score"))
            .where((F.col("score") >= min_score) & (F.col("instances") >= min_instances)).drop("instances"), "accepted")
        missed = F.exp(F.sum(F.log(F.lit(1.0) - F.least("score", F.lit(0.999)))))
        found = (
            graph.where("seed = ''").select("instance", "pattern").join(accepted, "pattern")
            .groupBy("instance").agg(F.max_by("as", F.struct("score", "as")).alias("as"), (1 - missed).alias("belief"))
        )
        known = written(seeds.unionByName(found), "known-instances")
    return accepted.select("pattern", "as")


def learn_patterns(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, min_score: float = MIN_SCORE,
                   min_instances: int = MIN_INSTANCES) -> dict[str, str]:
    """``accepted_patterns`` as a dict on the driver."""
    accepted = accepted_patterns(docs, text_col, rounds, min_score, min_instances)
    return {r["pattern"]: r["as"] for r in accepted.collect()}


def all_spans(text: str, patterns: dict[str, str]) -> tuple[list, list]:
    """Base spans, and base and added spans together, by kind, then start."""
    base = base_spans(text)
    if not patterns:
        return base, base
    added, words = [], Words(text)
    for s, e in candidate_spans(text, base):
        kind = patterns.get(words.pattern_before(s) or "")
        if kind:
            added.append((KINDS.index(kind), s, e))
    return base, sorted(base + added) if added else base


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_record(batches):
        seen: dict = {}
        for key, text in zip(*[c.to_pylist() for c in batch.columns]):
            words = Words(text)
            for s, _ in candidate_spans(text, base_spans(text)):
                pattern = words.pattern_before(s)
                if pattern:
                    seen[key, pattern] = None
        if seen:
            keys, patterns = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(patterns)], names=["text_key", "pattern"])


def _few(patterns: dict[str, str] | DataFrame, in_task: int) -> dict[str, str] | None:
    """The patterns as a dict if a task may hold them."""
    if isinstance(patterns, dict):
        return patterns
    rows = patterns.limit(in_task + 1).collect()
    return {r["pattern"]: r["as"] for r in rows} if len(rows) <= in_task else None


def _joined(docs: DataFrame, patterns: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the patterns of each row's text as map ``name``; at most one entry per candidate."""
    key = F.sha2(F.col(text_col).cast("string").cast("binary"), 256)
    texts = docs.select(key.alias("text_key"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    own = written(
        texts.mapInArrow(_contexts, "text_key string, pattern string").distinct().join(patterns, "pattern")
        .groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("pattern", "as"))).alias("own")), "own-patterns")
    rows, keyed = unused_name(docs, "text_hash"), own.select(F.col("text_key").alias("own_key"), F.col("own").alias(name))
    out = docs.withColumn(rows, key)
    return out.join(keyed, out[rows] == keyed["own_key"], "left").select(*docs.columns, keyed[name])


def _own(batch: pa.RecordBatch, few: dict[str, str] | None, at: int) -> Iterable[dict[str, str]]:
    """The patterns that may apply to each row: the few, or those joined as column ``at``."""
    return [few] * batch.num_rows if few is not None else (dict(m or ()) for m in batch.column(at).to_pylist())


def find(docs: DataFrame, patterns: dict[str, str] | DataFrame, id_col: str = "doc_id", text_col: str = "text", in_task: int = IN_TASK) -> DataFrame:
    """(id, base, spans) of every row: the rules' spans, and these with the added ones.

    Places count code points, ends are exclusive. NULL and empty texts have none.
    Repeated rows and NULL ids are treated like others; other columns are ignored.
    More than ``in_task`` patterns are joined to the rows.
    """
    few = _few(patterns, in_task)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            columns: tuple[list, list] = [], []
            for text, own in zip(batch.column(1).to_pylist(), _own(batch, few, 2)):
                for column, spans in zip(columns, all_spans(text or "", own)):
                    column.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, _SPANS_ARROW) for c in columns]], names=["doc_id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if few is None:
        chosen = _joined(chosen, patterns, "text", "own")
    return chosen.mapInArrow(run, f"doc_id {kind}, base {_SPANS}, spans {_SPANS}")


def masked(text: str, patterns: dict[str, str]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlaps count once."""
    out, last = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in all_spans(text, patterns)[1]):
        if start >= last:
            out += [text[last:start], f"<{KINDS[kind].upper()}>"]
        last = max(last, end)
    return "".join([*out, text[last:]]) if out else text


def mask(docs: DataFrame, patterns: dict[str, str] | DataFrame, text_col: str = "text", in_task: int = IN_TASK) -> DataFrame:
    """``docs`` with the personal data of its texts masked; NULL texts and all other columns stay.

    More than ``in_task`` patterns are joined to the rows.
    """
    at, width, few = docs.columns.index(text_col), len(docs.columns), _few(patterns, in_task)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            texts = [None if t is None else masked(t, own)
                     for t, own in zip(batch.column(at).to_pylist(), _own(batch, few, width))]
            columns = list(batch.columns)[:width]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    rows = docs.withColumn(text_col, F.col(text_col).cast("string"))
    if few is None:
        rows = _joined(rows, patterns, text_col, unused_name(docs, "own"))
    return rows.mapInArrow(run, docs.schema)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
