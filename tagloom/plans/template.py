"""The run of one tag job: rule, source, compute, merge, write."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.profile import drop_tags, merge_all_users
from tagloom.operators.rules import SourceSpec, child_rules, source_spec
from tagloom.plans.state import StateStore, UserState, summed
from tagloom.session import materialised
from tagloom.sources.readers import read_fields
from tagloom.sources.stores import ProfileStore

Compute = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class FromState:
    """What a job needs of its table's state, and the function that turns (state, rules) into ``(userId, tagsId)``."""

    state: UserState
    measures: tuple[str, ...]
    compute: Compute
    detail: bool = False


@dataclass(frozen=True)
class TagJob:
    """A tag and the function that turns (source, rules) into ``(userId, tagsId)``.

    The ``tagsId`` of a job for products is a best-first list of product ids, which are no tags. A job with ``shared`` can be
    computed from the state of its table as well, which all such jobs of a run have in common.
    """

    tag_id: int
    compute: Compute
    products: bool = False
    shared: FromState | None = None


@dataclass(frozen=True)
class KeptStates:
    """Folder of the states kept between runs, and the column whose growth tells new rows."""

    root: str
    new_by: str
    keep: int | None = None


def parquet_source(spark: SparkSession, root: str) -> Callable[[SourceSpec], DataFrame]:
    """Reader for specs whose table is a Parquet table below ``root``; the columns keep their types."""
    return lambda spec: read_fields(spark, f"{root.rstrip('/')}/{spec.table}.parquet", spec.fields, as_text=False)


def shared_states(jobs: Sequence[TagJob], tags: DataFrame, read_source: Callable[[SourceSpec], DataFrame],
                  kept: KeptStates | None = None) -> dict[int, DataFrame]:
    """The state that each job with ``shared`` is computed from, by tag.

    Jobs of one table share one scan, which reads the columns that any of them needs and is combined into one small written
    table. A single job of a table reads it by itself, unless states are kept: then the run adds the table's new rows to the
    kept state, whichever jobs it runs.
    """
    groups: dict[tuple[str, str, str], list[tuple[TagJob, SourceSpec]]] = {}
    for job in jobs:
        if job.shared is not None:
            spec = source_spec(tags, job.tag_id)
            groups.setdefault((spec.in_type, spec.table, job.shared.state.name), []).append((job, spec))
    found = {}
    for (_, table, name), members in groups.items():
        state = members[0][0].shared.state
        names = [m.name for m in state.measures if kept or any(m.name in job.shared.measures for job, _ in members)]
        if kept is not None:
            fields = tuple(dict.fromkeys([*state.fields(names), kept.new_by]))
            store = StateStore(tags.sparkSession, f"{kept.root.rstrip('/')}/{table}-{name}", state, names, kept.keep)
            rows = store.add(read_source(replace(members[0][1], fields=fields)), kept.new_by)
        elif len(members) > 1:
            detail = any(job.shared.detail for job, _ in members)
            spec = replace(members[0][1], fields=tuple(state.fields(names, detail)))
            rows = materialised(summed(read_source(spec), state, names, detail), "state")
        else:
            continue
        found |= {job.tag_id: rows for job, _ in members}
    return found


def compute_tags(job: TagJob, tags: DataFrame, read_source: Callable[[SourceSpec], DataFrame], state: DataFrame | None = None) -> DataFrame:
    if state is not None:
        return job.shared.compute(state, child_rules(tags, job.tag_id)).select("userId", "tagsId")
    source = read_source(source_spec(tags, job.tag_id))
    return job.compute(source, child_rules(tags, job.tag_id)).select("userId", "tagsId")


ProductStores = ProfileStore | Callable[[int], ProfileStore]


def run_jobs(jobs: Sequence[TagJob], tags: DataFrame, read_source: Callable[[SourceSpec], DataFrame],
             store: ProfileStore, replace_siblings: bool = False, products: ProductStores | None = None,
             kept: KeptStates | None = None) -> DataFrame:
    """Compute the tags of the jobs, add them to the profile and return the written profile.

    All jobs share one merge and one write of the profile, and jobs of one table one scan of it. A tag once given
    stays, as in a plain union. With ``replace_siblings`` the jobs' earlier
    tags are taken away first, so a user who moved to another band holds only
    the new one. Product lists go to a store of their own, one for each tag where ``products`` is a function of the tag, and a
    user's new list takes the place of the old one and keeps its order. Everything is computed before anything is written.
    """
    listing = [job for job in jobs if job.products]
    if listing and products is None:
        raise ValueError(f"the products of tag {listing[0].tag_id} need a store of their own")
    if len(listing) > 1 and not callable(products):
        raise ValueError("the products of several tags need a store each")
    tagging = [job for job in jobs if not job.products]
    base = store.version()
    states = shared_states(jobs, tags, read_source, kept)
    lists = [(job, materialised(compute_tags(job, tags, read_source, states.get(job.tag_id)), "products")) for job in listing]
    none = store.read(0)
    new = reduce(DataFrame.unionByName, [compute_tags(job, tags, read_source, states.get(job.tag_id)) for job in tagging], none)
    new = materialised(new, "tags") if listing else new
    for job, rows in lists:
        (products(job.tag_id) if callable(products) else products).upsert(rows)
    if not replace_siblings or not tagging:
        # Every run leaves a version, so the versions count the runs.
        return store.add(new, base)
    own = [child_rules(tags, job.tag_id) for job in tagging]
    old = drop_tags(store.read(base), reduce(DataFrame.unionByName, own))
    return store.replace(merge_all_users(new, old), base)


def run_job(job: TagJob, tags: DataFrame, read_source: Callable[[SourceSpec], DataFrame], store: ProfileStore,
            replace_siblings: bool = False, products: ProductStores | None = None) -> DataFrame:
    return run_jobs([job], tags, read_source, store, replace_siblings, products)
