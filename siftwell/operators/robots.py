"""robots.txt rules: the groups for every agent, and the pages they close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import trim_space
from siftwell.functions.urls import host_of, url_parts


def parse_robots(txt: Column) -> Column:
    """Disallowed paths of the groups that name ``*``, as one array.

    One file is one row, so its lines are folded in place: consecutive agent lines form a group,
    any other line ends the list of agents.
    """
    lines = F.transform(F.split(txt, r"\r?\n"), lambda x: trim_space(F.regexp_replace(x, "#.*", "")))
    start = F.struct(
        F.lit(False).alias("applies"), F.lit(False).alias("agents"), F.array().cast("array<string>").alias("rules")
    )

    def step(state: Column, line: Column) -> Column:
        key = F.lower(trim_space(F.split_part(line, F.lit(":"), F.lit(1))))
        colon = F.instr(line, ":")
        value = F.when(colon > 0, trim_space(line.substr(colon + 1, F.length(line)))).otherwise(F.lit(""))
        agent = key == "user-agent"
        closes = (key == "disallow") & (value != "") & state["applies"]
        return F.struct(
            F.when(agent, (state["agents"] & state["applies"]) | (value == "*")).otherwise(state["applies"]).alias("applies"),
            F.when(agent, F.lit(True)).when(key != "", F.lit(False)).otherwise(state["agents"]).alias("agents"),
            F.when(closes, F.concat(state["rules"], F.array(value))).otherwise(state["rules"]).alias("rules"),
        )

    return F.aggregate(lines, start, step)["rules"]


def rule_pattern(rule: Column) -> Column:
    """A rule is a path prefix in which ``*`` stands for anything; all else is literal."""
    literal = F.regexp_replace(rule, r"([.+?^${}()|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(literal, r"\*", ".*"))


def blocked(rules: Column, path: Column) -> Column:
    """Any rule matches. Rules see the path only, so a rule about the query never fires."""
    return F.exists(rules, lambda r: F.rlike(path, rule_pattern(r)))


def robots_filter(pages: DataFrame, robots: DataFrame) -> DataFrame:
    """Pages their host's robots file (``host, txt``, one per host) does not close.

    An equi join on the host, whose rules are one small array. One host may own any share of the
    pages; adaptive execution splits such a key.
    """
    rules = robots.select("host", parse_robots(F.col("txt")).alias("_rules"))
    placed = pages.withColumn("_u", url_parts(F.col("url"))).select(
        "*", host_of(F.col("_u")).alias("host"), F.col("_u.path").alias("_path")
    )
    joined = placed.drop("_u").join(rules, "host", "left")
    return joined.where(~F.coalesce(blocked(F.col("_rules"), F.col("_path")), F.lit(False))).drop("_rules", "_path", "host")
