"""Batch scoring of postings with a model function, and reading its replies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siftwell.functions.bind import let
from siftwell.functions.text import trim_space
from siftwell.operators.distinct import latest_per_key
from siftwell.operators.evaluate import with_cost
from siftwell.runtime import cut_lineage
from siftwell.schema import EMPLOYMENT_TYPES, Pricing
from siftwell.sources.payloads import field, is_number, kind, number_text, one_value

# A scorer takes (system, user) and returns (text, input tokens, output tokens). It is made from
# the number of the attempt, counted from 0.
Scorer = Callable[[str, str], tuple[str, int, int]]
MakeScorer = Callable[[int], Scorer]

FIELDS = ("company", "title", "location", "description")
NOT_GIVEN = "not given"


@dataclass(frozen=True)
class Prompt:
    """A named prompt of the caller's. ``user`` is a text in which ``{company}``, ``{title}``,
    ``{location}`` and ``{description}`` stand for the posting's fields."""

    version: str
    system: str
    user: str


# A neutral example; what decides eligibility is for the caller to say.
ANSWER = (
    "Answer as JSON with the fields eligible (boolean), employmentType (" + ", ".join(EMPLOYMENT_TYPES) + "),"
    " regionConstraint, confidence (0 to 1) and reason."
)
SHORT = Prompt("short", ANSWER, "{title}\n{company}\n{location}")
FULL = Prompt("full", ANSWER, "{title}\n{company}\n{location}\n\n{description}")

# Reasons given without a model, and the retry schedule.
FAILED, DISABLED = "classification failed", "classifier disabled"
NOT_BOOLEAN = "missing or non-boolean 'eligible'"
NO_OBJECT = "no JSON object in response"
MAX_RETRIES, BACKOFF_SECONDS = 2, 0.4
CALLS_AT_ONCE = 4


def render_prompt(prompt: Prompt) -> Column:
    """The user part of a prompt as a column over company, title, location, description."""
    parts, rest = [], prompt.user
    while rest:
        at = {rest.find("{" + f + "}"): f for f in FIELDS if "{" + f + "}" in rest}
        if not at:
            break
        first = min(at)
        name = at[first]
        value = F.col(name)
        parts += [F.lit(rest[:first]), F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(F.lit(NOT_GIVEN))]
        rest = rest[first + len(name) + 2 :]
    return F.concat(*parts, F.lit(rest))


def extract_json(response: Column) -> Column:
    """The JSON value of a reply: the whole text, the first fence, or its outermost braces."""
    fence = r"(?s)```(?:json)?(.*?)```"

    def body(t: Column) -> Column:
        return F.when(t.rlike(fence), trim_space(F.regexp_extract(t, fence, 1))).otherwise(t)

    def read(candidate: Column) -> Column:
        braces = F.regexp_extract(candidate, r"(?s)\{.*\}", 0)
        return F.coalesce(one_value(candidate), F.when(braces != "", one_value(braces)))

    return let(let(trim_space(F.coalesce(response, F.lit(""))), body), read)


def _as_text(value: Column, fallback: str) -> Column:
    shown = F.when(is_number(value), number_text(value)).otherwise(value.cast("string"))
    there = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))
    return F.when(there, shown).otherwise(F.lit(fallback))


def _confidence(value: Column) -> Column:
    number = (
        F.when(is_number(value), value.cast("double"))
        .when(kind(value) == "BOOLEAN", value.cast("boolean").cast("double"))
        .when(kind(value) == "STRING", trim_space(value.cast("string")).try_cast("double"))
    )
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))).otherwise(F.lit(0.0))


def parse_classification(response: Column) -> Column:
    """Classification struct from a reply; NULL where ``eligible`` is no real boolean.

    A text such as "yes" is refused rather than read as true.
    """

    def shape(v: Column) -> Column:
        eligible = field(v, "eligible")
        type_ = F.lower(_as_text(field(v, "employmentType"), "unknown"))
        return F.when(
            kind(eligible) == "BOOLEAN",
            F.struct(
                eligible.cast("boolean").alias("eligible"),
                F.when(type_.isin(*EMPLOYMENT_TYPES), type_).otherwise(F.lit("unknown")).alias("employment_type"),
                _as_text(field(v, "regionConstraint"), "").alias("region_constraint"),
                _confidence(field(v, "confidence")).alias("confidence"),
                _as_text(field(v, "reason"), "").alias("reason"),
            ),
        )

    return let(extract_json(response), shape)


def fixed_classification(eligible: bool, reason: Column | str) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(
        F.lit(eligible).alias("eligible"),
        F.lit("unknown").alias("employment_type"),
        F.lit("").alias("region_constraint"),
        F.lit(0.0).alias("confidence"),
        reason.alias("reason"),
    )


_REPLIES = "id string, asked string, user string, response string, error string, input_tokens bigint, output_tokens bigint"


def ask(prompts: DataFrame, make_scorer: MakeScorer, system: str, attempt: int, calls_at_once: int) -> DataFrame:
    """One reply, or the error of the call, for each ``(id, asked, user)``. Token counts add to what
    ``prompts`` already carries.

    The scorer is made once per partition and must allow ``calls_at_once`` calls side by side.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer(attempt)

        def call(user: str) -> tuple:
            try:
                response, used_in, used_out = scorer(system, user)
                return response, None, used_in, used_out
            except Exception as e:  # any failure of the model call
                return None, str(e), 0, 0

        with ThreadPoolExecutor(calls_at_once) as pool:
            for frame in frames:
                replies = pd.DataFrame(
                    list(pool.map(call, frame["user"])), columns=["response", "error", "input_tokens", "output_tokens"]
                )
                for spent in ("input_tokens", "output_tokens"):
                    replies[spent] += frame[spent].to_numpy()
                yield replies.assign(**{c: frame[c].to_numpy() for c in ("id", "asked", "user")})

    return prompts.select("id", "asked", "user", "input_tokens", "output_tokens").mapInPandas(run, _REPLIES)


def score_batch(
    postings: DataFrame,
    make_scorer: MakeScorer,
    prompt: Prompt,
    parallelism: int | None = None,
    retries: int = MAX_RETRIES,
    backoff: float = BACKOFF_SECONDS,
    calls_at_once: int = CALLS_AT_ONCE,
) -> DataFrame:
    """Scores per posting ``id``, each there once: classification, token counts, whether scoring failed.

    Only the id and the prompt text reach Python. Scoring goes in rounds: all postings are asked,
    the replies are read and kept in the checkpoint folder, and those without a usable reply are
    asked again, with the prompt and the tokens spent so far taken from there; the wait between
    rounds holds no task. ``asked`` is a hash of the prompt. ``parallelism`` sets the number of
    partitions, each with ``calls_at_once`` calls.
    """
    user, none = render_prompt(prompt), F.lit(0).cast("bigint")
    pending = postings.select(
        "id", asked_hash(prompt).alias("asked"), user.alias("user"), none.alias("input_tokens"), none.alias("output_tokens")
    )
    settled = []
    for attempt in range(retries + 1):
        if parallelism:
            pending = pending.repartition(parallelism)
        replies = ask(pending, make_scorer, prompt.system, attempt, calls_at_once)
        response = F.col("response")
        unread = F.when(extract_json(response).isNull(), F.lit(NO_OBJECT)).otherwise(F.lit(NOT_BOOLEAN))
        parsed = let(parse_classification(response), lambda c: F.struct(c.alias("c"), F.when(c.isNull(), unread).alias("why")))
        read = replies.withColumn("reply", F.when(F.col("error").isNull(), parsed)).select(
            "id",
            "asked",
            F.col("reply.c").alias("parsed"),
            F.coalesce("error", "reply.why").alias("error"),
            F.when(F.col("reply.c").isNull(), F.col("user")).alias("user"),
            "input_tokens",
            "output_tokens",
        )
        failures = Observation()
        read = cut_lineage(read.observe(failures, F.count_if(F.col("parsed").isNull()).alias("n")))
        failed = F.col("parsed").isNull()
        if attempt == retries or not failures.get["n"]:
            settled.append(read)
            break
        settled.append(read.where(~failed))
        pending = read.where(failed)
        time.sleep(backoff * 2**attempt)
    why = F.concat(F.lit(FAILED + ": "), F.col("error"))
    return reduce(DataFrame.unionByName, settled).select(
        "id",
        "asked",
        F.lit(prompt.version).alias("version"),
        F.coalesce("parsed", fixed_classification(False, why)).alias("classification"),
        "input_tokens",
        "output_tokens",
        F.col("parsed").isNull().alias("failed"),
    )


def asked_hash(prompt: Prompt) -> Column:
    """Hash of what the model is asked about a posting."""
    return F.sha2(F.concat(F.lit(prompt.system + "\u0000"), render_prompt(prompt)), 256)


def score_once(postings: DataFrame, make_scorer: MakeScorer, prompt: Prompt, path: str, **options) -> DataFrame:
    """Score what ``path`` does not hold yet, append it there, and read the latest scores back.

    A row counts as held when its id was scored without failure under the same prompt text, so a
    rerun asks again for what failed and for postings that changed.
    """
    spark, todo = postings.sparkSession, postings
    if _exists(spark, path):
        done = spark.read.parquet(path).where((F.col("version") == prompt.version) & ~F.col("failed"))
        todo = todo.withColumn("asked", asked_hash(prompt)).join(done.select("id", "asked").distinct(), ["id", "asked"], "left_anti")
    scores = score_batch(todo, make_scorer, prompt, **options)
    scores.withColumn("scored_at", F.lit(time.time_ns())).write.mode("append").parquet(path)
    held = spark.read.parquet(path).where(F.col("version") == prompt.version)
    return latest_per_key(held, ["id"], "scored_at").drop("asked", "scored_at")


def _exists(spark, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def score_disabled(postings: DataFrame) -> DataFrame:
    """Without a model everything is eligible at confidence 0, which sends it all to review."""
    return postings.withColumn("classification", fixed_classification(True, DISABLED))


def score_stats(scores: DataFrame, by: list[str] | None = None, pricing: Pricing = Pricing()) -> DataFrame:
    """Calls (one per posting), failures, tokens and cost."""
    sums = scores.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if("failed").alias("failures"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )
    return with_cost(sums, pricing)
