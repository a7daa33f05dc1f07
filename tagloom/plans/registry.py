"""The tags that can be computed, by the id of their level-4 tag."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tagloom.functions.scores import RFE_BINS, RFM_BINS
from tagloom.plans import tags
from tagloom.plans.state import LOGS, ORDERS
from tagloom.plans.template import FromState, TagJob


@dataclass(frozen=True)
class JobOptions:
    """Day recency is counted from, days to shift it back, folder for fitted models, the orders table that the
    shopping gender needs beside its goods, and what becomes of a value without a rule."""

    as_of: str
    shift_days: int = 0
    model_root: str | None = None
    refresh: bool = False
    orders: Callable[[], DataFrame] | None = None
    on_missing: str = "error"

    def model(self, name: str) -> dict:
        path = f"{self.model_root.rstrip('/')}/{name}" if self.model_root else None
        return {"model_path": path, "refresh": self.refresh}


# Ids of the level-4 tags.
GENDER, JOB, AGE, CYCLE, PAYMENT, RFM, RFE, PSM, USG, BP = 4, 7, 14, 23, 29, 37, 45, 50, 56, 60

_JOBS: dict[int, Callable[[JobOptions], Callable[[DataFrame, DataFrame], DataFrame]]] = {
    GENDER: lambda o: lambda source, rules: tags.exact_tag(source, rules, "gender", on_missing=o.on_missing),
    JOB: lambda o: lambda source, rules: tags.exact_tag(source, rules, "job", on_missing=o.on_missing),
    AGE: lambda o: lambda source, rules: tags.age_tag(source, rules),
    CYCLE: lambda o: lambda source, rules: tags.cycle_tag(source, rules, o.as_of, o.shift_days),
    PAYMENT: lambda o: lambda source, rules: tags.payment_tag(source, rules),
    RFM: lambda o: lambda source, rules: tags.rfm_tag(source, rules, o.as_of, o.shift_days, **o.model("rfm")),
    RFE: lambda o: lambda source, rules: tags.rfe_tag(source, rules, o.as_of, o.shift_days, **o.model("rfe")),
    PSM: lambda o: lambda source, rules: tags.psm_tag(source, rules, **o.model("psm")),
    USG: lambda o: lambda source, rules: tags.usg_tag(source, rules, o.orders()),
    BP: lambda o: lambda source, rules: tags.bp_tag(source, rules),
}

# What these jobs need of the state of their table, and how they are computed from it.
_SHARED: dict[int, Callable[[JobOptions], FromState]] = {
    CYCLE: lambda o: FromState(ORDERS, ("last_time",), lambda state, rules: tags.cycle_of_state(state, rules, o.as_of, o.shift_days)),
    PAYMENT: lambda o: FromState(ORDERS, ("codes",), tags.payment_of_state, detail=True),
    RFM: lambda o: FromState(ORDERS, ("last_time", "orders", "amount"), lambda state, rules: tags.cluster_tag(
        tags.score(tags.rfm_of_state(state, o.as_of, o.shift_days), RFM_BINS), list(RFM_BINS), rules, **o.model("rfm"))),
    RFE: lambda o: FromState(LOGS, ("last_visit", "views"), lambda state, rules: tags.cluster_tag(
        tags.score(tags.rfe_of_state(state, o.as_of, o.shift_days), RFE_BINS), list(RFE_BINS), rules, seed=100, **o.model("rfe")), detail=True),
    PSM: lambda o: FromState(ORDERS, ("tdon", "ton", "tda", "tra"), lambda state, rules: tags.cluster_tag(
        tags.psm_of_state(state), ["psm"], rules, seed=100, **o.model("psm"))),
}


def job(tag_id: int, options: JobOptions) -> TagJob:
    if tag_id not in _JOBS:
        raise KeyError(f"no job for tag {tag_id}; known: {sorted(_JOBS)}")
    shared = _SHARED[tag_id](options) if tag_id in _SHARED else None
    return TagJob(tag_id, _JOBS[tag_id](options), products=tag_id == BP, shared=shared)
