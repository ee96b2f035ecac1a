"""URL filters: longest-prefix rules, then a host-word model.

Where no rule fits, the words of a url are judged. Each letter run of host and path is cut into words by unigram Viterbi over word counts of the pages' own
text; letters between words stay together as one unknown word. A multinomial naive Bayes over the words of host and path gives the odds of block.

There are no labels for urls. The naive Bayes takes as block examples the urls whose segmented host holds one of ``seeds``, words that name unwanted
trade, and all others as allow examples, so that words that keep company with seeds count against a url too. Rules and their verdicts are
no part of it: what they test (domains and the path's language) says nothing about a host's words.

Null urls and urls without ``://`` have an empty host and path; no rule fits them and they are allowed unless block examples prevail. A-Z alone is lower-cased. An
empty table gives no rows; without any block example the verdict is allow. Urls of any length are read whole; repeated rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, bound_batches, map_batches

#: (rule, verdict); a rule is a host and the start of a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Words whose hosts are block examples.
SEEDS = ("adserver", "ads", "bet", "bets", "casino", "escort", "gamble", "jackpot", "lottery", "payday", "pharma", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "tracker", "viagra", "warez", "xxx")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.translate(F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _decided(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; nulls where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of, slash, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) with nulls where no rule fits."""
    split = pages.select(id_col, F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"), F.coalesce(path_of(F.col(url_col)), F.lit("")).alias("path"))
    return split.withColumn("found", _decided(F.col("host"), F.col("path"), rules)).select(id_col, "host", "path", "found.rule", "found.verdict")


def _pieces(judged: DataFrame, longest: int) -> DataFrame:
    """The different strings (w) of up to ``longest`` letters that the letter runs of hosts and paths contain."""
    letters = lambda c: F.regexp_extract_all(F.translate(c, UPPER, LOWER), F.lit("([a-z]+)"), 1)
    runs = judged.select(F.explode(F.concat(letters("host"), letters("path"))).alias("run")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                for i in range(len(x)):
                    found.update(x[i:j] for j in range(i + 1, min(len(x), i + longest) + 1))
                    if len(found) > 100_000:
                        yield pa.record_batch([pa.array(list(found), pa.string())], names=["w"])
                        found.clear()
        if found:
            yield pa.record_batch([pa.array(list(found), pa.string())], names=["w"])

    bound_batches(judged.sparkSession)
    return runs.mapInArrow(run, "w string").distinct()


def word_counts(pages: DataFrame, judged: DataFrame, scratch: Scratch, text_col: str = "html") -> tuple[dict[str, int], int]:
    """Counts of all those words of the pages' text, tags left out, that a host or path contains, and the count of all words.

    Every page and word is counted in a table; what leaves it grows with the different words in urls, not with the text."""
    words = F.explode(F.split(F.lower(F.regexp_replace(F.col(text_col), r"<[^>]*>", " ")), r"\P{L}+"))
    table = scratch.cut(pages.where(F.col(text_col).isNotNull()).select(words.alias("w")).where(F.col("w").rlike("^[a-z]+$")).groupBy("w").agg(F.count("*").alias("n")))
    total, longest = table.agg(F.sum("n"), F.max(F.length("w"))).first()
    found = table.join(_pieces(judged, longest or 1).hint("merge"), "w", "left_semi").select("w", "n").toArrow()
    scratch.drop(table)
    return dict(zip(found.column("w").to_pylist(), found.column("n").to_pylist(), strict=True)), total or 0


class Segmenter:
    """Unigram Viterbi: the split of a name with the highest product of word probabilities. A run of letters that is no word is one unknown word,
    ten times rarer than the rarest word for its first letter and for each further one, so that it is taken only where nothing else fits."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        """total: the count of all words, where counts has only those that the names contain."""
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown, self.letter = math.log(total), math.log(10)
        self.longest = max(map(len, counts), default=1)
        self.known: dict[str, list[str]] = {}

    def words(self, name: str) -> list[str]:
        if (out := self.known.get(name)) is None:
            if len(self.known) > 100_000:
                self.known.clear()
            out = self.known[name] = [w for run in re.findall(r"[a-z]+|[0-9]+|[^a-z0-9.\-]+", name) for w in (self._split(run) if run[0] in LOWER else [run])]
        return out

    def _split(self, run: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        # the best place for an unknown word to start: its cost grows by one letter's with each step
        lowest = (0.0, 0)
        for end in range(1, len(run) + 1):
            options = [(lowest[0] + self.unknown + self.letter * end, lowest[1])]
            for start in range(max(0, end - self.longest), end):
                if (cost := self.cost.get(run[start:end])) is not None:
                    options.append((best[start][0] + cost, start))
            best.append(min(options))
            lowest = min(lowest, (best[end][0] - self.letter * end, end))
        out, end = [], len(run)
        while end:
            start = best[end][1]
            out.append(run[start:end])
            end = start
        return out[::-1]


def tokens(segmenter: Segmenter, host: str, path: str) -> list[str]:
    """Words of the host and of the path; digits count by their number."""
    out = [f"host:{w}" for w in segmenter.words(host)]
    for part in re.findall(r"[A-Za-z]+|[0-9]+", path):
        out += [f"digits:{len(part)}"] if part.isdigit() else [f"path:{w}" for w in segmenter.words(part.lower())]
    return out


def _tokenised(judged: DataFrame, model: Broadcast, seeds: Sequence[str], id_col: str) -> DataFrame:
    """Adds tokens, and whether the host holds a seed."""
    cut: list[Segmenter] = []
    named = {f"host:{w}" for w in seeds}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cut:
            cut.append(Segmenter(*model.value))
        found = [tokens(cut[0], h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        return pa.record_batch([*batch.columns, pa.array(found, pa.list_(pa.string())), pa.array([not named.isdisjoint(x) for x in found], pa.bool_())], names=[*batch.schema.names, "tokens", "seeded"])

    kind = judged.schema[id_col].dataType.simpleString()
    return map_batches(judged, run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, tokens array<string>, seeded boolean")


def naive_bayes(tokenised: DataFrame) -> tuple[float, dict[str, float], float]:
    """(prior, weight by token, weight of an unseen token) of block against allow, with add-one smoothing, over all urls and all their tokens."""
    block = F.col("seeded").cast("long")
    urls = tokenised.agg(F.count("*").alias("n"), F.sum(block).alias("block")).first()
    by_token = tokenised.select(F.explode("tokens").alias("t"), block.alias("block")).groupBy("t").agg(F.count("*").alias("n"), F.sum("block").alias("block")).toArrow()
    rows = list(zip(*(by_token.column(c).to_pylist() for c in ("t", "n", "block")), strict=True))
    blocked, allowed = sum(b for _, _, b in rows), sum(n - b for _, n, b in rows)
    size = len(rows) + 1
    weight = lambda b, a: math.log((b + 1) / (blocked + size)) - math.log((a + 1) / (allowed + size))
    n, b = urls["n"] or 0, urls["block"] or 0
    return math.log((b + 1) / (n - b + 1)), {t: weight(b, n - b) for t, n, b in rows}, weight(0, 0)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(id, host, path, rule, verdict, words, block_score): the longest rule's verdict, else block where the model's probability of block is over one half."""
    decided, scratch = judged_by_rules(pages, rules, id_col, url_col), Scratch(pages.sparkSession)
    context = pages.sparkSession.sparkContext
    # segmented once; what follows reads the written table
    tokenised = scratch.cut(_tokenised(decided, context.broadcast(word_counts(pages, decided, scratch, text_col)), seeds, id_col))
    bayes = naive_bayes(tokenised)
    shared, seen = context.broadcast(bayes), bool(tokenised.where("seeded").take(1))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, scores, (prior, weights, unseen) = [], [], shared.value
        for found in batch.column("tokens").to_pylist():
            words.append(" ".join(found))
            odds = prior + sum(weights.get(t, unseen) for t in found)
            scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))) if seen else 0.0)
        verdict = [v or ("block" if s > 0.5 else "allow") for v, s in zip(batch.column("verdict").to_pylist(), scores, strict=True)]
        return pa.record_batch([batch.column(id_col), batch.column("host"), batch.column("path"), batch.column("rule"), pa.array(verdict, pa.string()), pa.array(words, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "host", "path", "rule", "verdict", "words", "block_score"])

    kind = decided.schema[id_col].dataType.simpleString()
    return map_batches(tokenised, run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, words string, block_score double")
