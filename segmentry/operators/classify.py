"""Industry of a campaign name: batches, prompts, a user-supplied classifier, answer parsing, three rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentry.config import (
    INDUSTRIES, INDUSTRY_HINTS, INDUSTRY_OVERRIDES, INDUSTRY_SYNONYMS, NAME_NOISE, NULL_TOKENS, OTHER_INDUSTRY,
)
from segmentry.functions.scalar import replace_values
from segmentry.functions.text import all_digits, blank_to_null, parts, separators, strip
from segmentry.operators.ordering import batch_numbers, dense_ids, keep_first, keep_last, running_total
from segmentry.session import cut

Classifier = Callable[[str], str]


def prompt_template(
    hints: Mapping[str, Sequence[str]] = INDUSTRY_HINTS,
    overrides: Mapping[str, str] = INDUSTRY_OVERRIDES,
    other: str = OTHER_INDUSTRY,
    answer_only: bool = False,
) -> str:
    """Instructions for a language model, with `{names_list}` where a batch of names goes."""
    guide = "\n".join(f"- {label}: {', '.join(words)}" for label, words in hints.items())
    special = "\n".join(f"- {pattern} -> {label}" for pattern, label in overrides.items())
    closing = "\nStart with the first answer line; write nothing before it." if answer_only else ""
    return (
        "Assign exactly one INDUSTRY to every advertised item below. Ignore quiz and promotion wording.\n"
        f"Classes and typical items:\n{guide}\n- {other}: none of the above, or unknown\n"
        f"Special cases, which come first:\n{special}\n"
        "Answer with one line per item, in the form: ADS_IDX | NAME | INDUSTRY. Keep every ADS_IDX unchanged."
        f"{closing}\n\n{{names_list}}\n"
    )


def build_batches(names: DataFrame, size: int = 100) -> DataFrame:
    """Distinct names with dense ids and a batch number."""
    return batch_numbers(dense_ids(names, "NAME", "ADS_IDX"), "ADS_IDX", size)


def build_prompts(batches: DataFrame, template: str) -> DataFrame:
    """One prompt per batch. A batch holds at most as many names as `build_batches` was told."""
    line = F.concat_ws(" | ", F.col("ADS_IDX").cast("string"), "NAME")
    lines = F.sort_array(F.collect_list(F.struct("ADS_IDX", line.alias("line"))))
    return batches.groupBy("batch").agg(lines.alias("lines")).select(
        "batch",
        F.replace(
            F.lit(template), F.lit("{names_list}"), F.array_join(F.col("lines.line"), "\n")
        ).alias("prompt"),
    )


def classify(prompts: DataFrame, classifier: Classifier, concurrency: int = 50) -> DataFrame:
    """Call the classifier once per prompt, on at most `concurrency` tasks at a time.

    The answers are checkpointed: an external call is slow and need not answer the same way twice.
    """

    def ask(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"batch": frame["batch"], "answer": [classifier(p) for p in frame["prompt"]]})

    return cut(prompts.repartition(concurrency, "batch").mapInPandas(ask, "batch long, answer string"))


_LEDGER = "key string, batch long, answer string, error string, asked timestamp"


def ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """All calls of a ledger: `key` (hash of the prompt), `batch`, `answer` or `error`, `asked`. Empty before the first call."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def ledger_state(spark: SparkSession, ledger: str) -> DataFrame:
    """Per key: the first answer (NULL if there is none) and the number of failed calls."""
    is_answer = F.col("error").isNull()
    return ledger_rows(spark, ledger).groupBy("key").agg(
        F.min_by(F.when(is_answer, F.col("answer")), F.when(is_answer, F.struct("asked", "answer"))).alias("answer"),
        F.max(is_answer).alias("is_answered"), F.count_if(~is_answer).alias("failures"),
    )


def classify_with_ledger(
    prompts: DataFrame, classifier: Classifier, ledger: str, concurrency: int = 50, wave: int = 1000, attempts: int = 3
) -> DataFrame:
    """As `classify`, but every call is kept in the ledger, and only prompts without an answer there are asked.

    Calls are made in waves of at most `wave` prompts, in batch order; each wave is appended when it is done, so that a
    stopped run loses one wave. A call that fails is noted and costs no other answer; it is made up to `attempts` times in
    a run. Prompts that are then still without an answer end the run with an error; the next run asks only them.
    """
    spark = prompts.sparkSession

    def ask(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, batch, prompt in zip(frame["key"], frame["batch"], frame["prompt"]):
                answer, error = None, None
                try:
                    answer = classifier(prompt)
                except Exception as failure:  # whatever the call raises is kept beside the prompt's key
                    error = f"{type(failure).__name__}: {failure}"
                yield pd.DataFrame({"key": [key], "batch": [batch], "answer": [answer], "error": [error], "asked": [pd.Timestamp.now()]})

    keyed = cut(prompts.withColumn("key", F.sha2(F.col("prompt").cast("binary"), 256)).dropDuplicates(["key", "batch"]))

    def answered() -> DataFrame:
        # The state grows with the prompts while its files stay small; the hint keeps it out of a broadcast.
        return keyed.join(ledger_state(spark, ledger).hint("merge"), "key", "left").withColumn("is_answered", F.coalesce("is_answered", F.lit(False)))

    # The waves are dealt once, so that each reads its own folder and neither all prompts nor the whole ledger.
    unasked = answered().filter(~F.col("is_answered")).groupBy("key").agg(F.min("batch").alias("batch"), F.first("prompt").alias("prompt"))
    unasked = cut(unasked)
    per_batch = cut(unasked.groupBy("batch").agg(F.count("*").alias("n")))
    first = running_total(per_batch, [], "batch", "n").select("batch", F.col("before").alias("first"))
    place = F.col("first") + F.row_number().over(W.partitionBy("batch").orderBy("key")) - 1
    dealt = unasked.join(first.hint("merge"), "batch").withColumn("wave", F.floor(place / wave)).drop("first")
    waves = cut(dealt.repartition("wave"), ["wave"])
    n_waves = -(-unasked.count() // wave)
    for number in range(n_waves):
        left = waves.filter(F.col("wave") == number).select("key", "batch", "prompt")
        for _ in range(attempts):
            asked = cut(left.repartition(concurrency, "key").mapInPandas(ask, _LEDGER))
            asked.write.mode("append").parquet(ledger)
            failed = asked.filter(F.col("error").isNotNull()).select("key")  # at most a wave
            if failed.isEmpty():
                break
            left = left.join(F.broadcast(failed), "key", "left_semi")
    found = cut(answered().select("batch", "answer", "is_answered"))
    n_open = found.filter(~F.col("is_answered")).count()
    if n_open:
        raise RuntimeError(f"{n_open} prompts have no answer after {attempts} calls each; their errors are in {ledger}")
    return found.select("batch", "answer")


def answer_lines(answers: DataFrame) -> DataFrame:
    """Lines of each answer, numbered."""
    lines = F.posexplode(F.split(strip(F.col("answer")), "\n")).alias("line_no", "line")
    return answers.select("batch", lines)


def _answer_rows(lines: DataFrame, null_tokens: Sequence[str]) -> DataFrame:
    return lines.select(
        "batch", "line_no",
        F.col("parts")[0].try_cast("long").alias("ADS_IDX"),
        F.col("parts")[1].alias("NAME"),
        blank_to_null(F.col("parts")[2], null_tokens).alias("INDUSTRY"),
    ).dropna(subset=["ADS_IDX"])


def parse_strict(answers: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Lines of exactly three parts; rulers (`---`) and header lines are skipped."""
    line = F.col("line")
    wanted = line.contains("|") & ~line.contains("---") & ~line.contains("ADS_IDX")
    rows = answer_lines(answers).filter(wanted).withColumn("parts", parts(line)).filter(F.size("parts") == 3)
    return _answer_rows(rows, null_tokens)


def parse_lenient(answers: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Lines of three or more parts that start with a number; parts after the third are ignored."""
    rows = (
        answer_lines(answers).filter(separators(F.col("line")) >= 2).withColumn("parts", parts(F.col("line")))
        .filter(all_digits(F.col("parts")[0]))
    )
    return _answer_rows(rows, null_tokens)


def merge_answers(master: DataFrame, answers: DataFrame) -> DataFrame:
    """Every name of the master with the first answer to its id. Batches count in the order of their file names."""
    ordered = answers.select(
        "ADS_IDX", "INDUSTRY", F.format_string("batch_%d_res.csv", F.col("batch")).alias("part"), "line_no"
    )
    first = keep_first(ordered, ["ADS_IDX"], ["part", "line_no"]).select("ADS_IDX", "INDUSTRY")
    return master.select("ADS_IDX", "NAME").join(first, "ADS_IDX", "left").select("NAME", "INDUSTRY")


def unanswered(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("INDUSTRY").isNull()).select("NAME").distinct()


def classification_round(
    names: DataFrame, classifier: Classifier, template: str, parse, size: int = 100, concurrency: int = 50, ledger: str | None = None
) -> DataFrame:
    batches = cut(build_batches(names, size))
    prompts = build_prompts(batches, template)
    answers = classify_with_ledger(prompts, classifier, ledger, concurrency) if ledger else classify(prompts, classifier, concurrency)
    return cut(merge_answers(batches, parse(answers)))


def cascade(
    names: DataFrame, classifiers: Sequence[Classifier], size: int = 100, concurrency: int = 50, ledger: str | None = None
) -> list[DataFrame]:
    """Up to three rounds: strict parsing first, then lenient; later rounds see unanswered names only.

    With a `ledger` folder each round keeps its calls there, and a run after a failure goes on where the last one ended.
    """
    settings = [
        (prompt_template(), parse_strict),
        (prompt_template(), parse_lenient),
        (prompt_template(answer_only=True), parse_lenient),
    ]
    rounds: list[DataFrame] = []
    left = names
    for number, (classifier, (template, parse)) in enumerate(zip(classifiers, settings), 1):
        own = f"{ledger}/round{number}" if ledger else None
        rounds.append(classification_round(left, classifier, template, parse, size, concurrency, own))
        left = unanswered(rounds[-1])
    return rounds


def union_rounds(rounds: Sequence[DataFrame]) -> DataFrame:
    tagged = [r.select("NAME", "INDUSTRY", F.lit(i).alias("round")) for i, r in enumerate(rounds)]
    return reduce(DataFrame.unionByName, tagged)


def finalize_mapping(
    rounds: Sequence[DataFrame],
    synonyms: Mapping[str, str] = INDUSTRY_SYNONYMS,
    industries: Sequence[str] = INDUSTRIES,
    other: str = OTHER_INDUSTRY,
) -> DataFrame:
    """Last answer per name; missing and catch-all answers dropped, synonyms mapped, the rest checked."""
    industry = F.col("INDUSTRY")
    return (
        keep_last(union_rounds(rounds), ["NAME"], ["round"])
        .dropna(subset=["INDUSTRY"])
        .filter(industry != other)
        .select("NAME", replace_values(industry, synonyms).alias("INDUSTRY"))
        .filter(industry.isin(list(industries)))
    )


def rule_industry(
    name: Column,
    hints: Mapping[str, Sequence[str]] = INDUSTRY_HINTS,
    overrides: Mapping[str, str] = INDUSTRY_OVERRIDES,
    noise: str = NAME_NOISE,
    other: str = OTHER_INDUSTRY,
) -> Column:
    """Industry by keyword: special cases first, then the hints in their order, else the catch-all class."""
    item = strip(F.regexp_replace(name, noise, " "))
    rules = [*overrides.items(), *[("|".join(words), label) for label, words in hints.items()]]
    matched = reduce(lambda expr, rule: expr.when(item.rlike(rule[0]), F.lit(rule[1])), rules, F)
    return matched.otherwise(F.lit(other))
