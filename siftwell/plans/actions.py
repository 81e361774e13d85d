"""The action stage: select, route, budget, record."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators import candidates, ledger, routing
from siftwell.operators.pages import extract_links
from siftwell.runtime import cut_lineage
from siftwell.schema import SelectionRules


@dataclass(frozen=True)
class ActionPlan:
    """Routed candidates, newest first, and how many submissions the day still allows."""

    routed: DataFrame
    budget: int


def plan_actions(
    scored: DataFrame,
    log: DataFrame,
    history: DataFrame,
    rules: SelectionRules,
    now: datetime,
    landed_pages: DataFrame | None = None,
) -> ActionPlan:
    """Candidates with their route. Aggregator postings are resolved by the links of their landed
    page (``url, html``), where there is one."""
    current = ledger.latest_records(log)
    picked = candidates.select_candidates(scored, current, history, rules, now)
    routed = cut_lineage(routing.with_route(picked, rules.try_unknown_sites))
    budget = candidates.submission_budget(current, rules, now).first()["budget"]
    if landed_pages is None:
        return ActionPlan(routed, budget)
    open_ = routed.where(F.col("route.lane") == "resolve").drop("route")
    links = extract_links(open_.join(landed_pages.select("url", "html"), "url").select("ord", "url", "html"))
    resolved = routing.resolve_aggregators(open_, links)
    settled = routed.where(F.col("route.lane") != "resolve")
    return ActionPlan(settled.unionByName(resolved), budget)
