"""One crawl round as a composition of batch jobs, state in -> state out.

validate (discovered URLs -> domains, sources, urls, frontier)
-> extract (drain the whole frontier once: route fetched pages by status,
   profile and filter the parsed ones)
-> transform (mentions, resolution, relevance, derived links)
-> load (references, rejected-mention queue, feedback for the next round)

The frontier is drained as one batch: each queued URL is looked at once per
round in priority order (a URL demoted on 500/502/503/504 stays queued for the
next round instead of being retried in the same drain).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import frontier as fr
from ..operators import load as ld
from ..operators import pages as pg
from ..operators.html_profile import profile_pages
from ..operators.mentions import spot_gazetteer
from ..operators.resolve import page_mentions, resolve_mentions
from ..operators.state import GraphState, assign_dense_ids, merged, queue_remove, queue_update
from ..session import cut_lineage
from ..sources import search as srch

Extractor = Callable[[DataFrame], DataFrame]   # (key, text) -> (key, mention)


def gazetteer_extractor(vocabulary: DataFrame, key: str = "url_id") -> Extractor:
    def run(docs: DataFrame) -> DataFrame:
        return spot_gazetteer(docs, vocabulary, key)
    return run


def discovered_from_search(seeds: DataFrame, responses: DataFrame, start: int = 1) -> DataFrame:
    """Seeds -> queries -> hits -> discovered batch (seq, url, relevance).

    ``seeds``: (pos, name, location, initial_search); ``responses``: (pos, query_idx,
    body), the landed answers to ``search_queries(seeds)``. Answers to queries that
    were not asked are left out; hits are numbered by seed and URL."""
    asked = srch.search_queries(seeds).select("pos", "query_idx")
    hits = srch.seed_hits(srch.result_urls(responses.join(asked, ["pos", "query_idx"], "left_semi")), seeds)
    return assign_dense_ids(hits, ["pos", "url"], "seq", start).select("seq", "url", "relevance")


def run_seed_round(state: GraphState, seeds: DataFrame, responses: DataFrame, fetched: DataFrame, extractor: Extractor,
                   as_of: str, fetch_order: str = "page_id") -> "RoundOutput":
    """I3 from its start: search, then a round over what it found."""
    last = state.sequence.agg(F.max("next_seq")).first()[0]
    found = discovered_from_search(seeds, responses, 1 if last is None else int(last))
    return run_round(state, found, fetched, extractor, as_of, fetch_order)


@dataclass(frozen=True)
class RoundOutput:
    state: GraphState
    routed: DataFrame        # url_id, full_url, status, action, drain_rank
    pages: DataFrame         # url_id, full_url, parent_priority, names, rejected, relevance, drain_rank
    references: DataFrame    # rows appended this round
    derived: DataFrame       # url_id, url, priority, is_homepage
    feedback: DataFrame      # seq, url, relevance (+ url_id, is_homepage): next round's discovered batch
    changes: dict[str, DataFrame]    # rows of the state's tables that the round wrote, by table
    gone: dict[str, DataFrame]       # keys of rows that it removed


#: Fetches to parse that are told to the scan of the pages; of more, all pages are parsed.
ASKED = 1 << 20


def run_round(state: GraphState, discovered: DataFrame, fetched: DataFrame, extractor: Extractor,
              as_of: str, fetch_order: str = "page_id", quality: DataFrame | None = None) -> RoundOutput:
    """``fetched``: (full_url, status, html) and ``fetch_order``, which numbers the
    fetches: the first fetch of a URL counts. Pages are parsed where they are read;
    joins and checkpoints carry their profiles, never the html. Fetches that were parsed
    already have the columns of ``profile_pages`` instead of html. ``quality``: see ``validate_changes``."""
    # validate
    changes, _ = fr.validate_changes(discovered, state, as_of, quality=quality)
    st = merged(state, changes)

    # extract: the whole frontier, in drain order
    front = fr.frontier_rank(st.url_queue, st.url)
    routed = cut_lineage(fr.route_fetched(front, fetched.select("full_url", "status", fetch_order), fetch_order))
    parsed = routed.where(F.col("action") == "parse").select("url_id", "full_url", "priority_int", "drain_rank", fetch_order)
    asked = fetched.where(fr.status_action("status") == "parse")
    if parsed.count() <= ASKED:                       # a small round parses its own pages only
        asked = asked.join(F.broadcast(parsed.select(fetch_order)), fetch_order, "left_semi")
    read = profile_pages(asked, [fetch_order]) if "html" in fetched.columns else asked.drop("full_url", "status")
    # a fetch that landed twice has two equal profiles; the join has put them together
    prof = cut_lineage(read.join(parsed, fetch_order).dropDuplicates([fetch_order]).repartition("url_id"))
    good = pg.meaningful(prof)
    demoted = routed.where(F.col("action") == "demote").select(
        "url_id", F.col("new_priority").alias("priority"), scoring.priority_int("new_priority").alias("priority_int"))
    gone = routed.where(F.col("action") != "demote").select("url_id")
    queue_next = queue_remove(queue_update(st.url_queue, demoted, "url_id"), gone, "url_id")

    # transform
    mentions = cut_lineage(extractor(good.select("url_id", "text")))
    resolved = resolve_mentions(mentions.select("mention"), st.entity)
    per_page = page_mentions(mentions, resolved, "url_id")
    pin = (good.select("url_id", "full_url", F.col("priority_int").alias("parent_priority"), "drain_rank")
           .join(per_page, "url_id", "left")
           .select("url_id", "full_url", "parent_priority", "drain_rank",
                   F.coalesce("names", F.array().cast("array<string>")).alias("names"),
                   F.coalesce("rejected", F.array().cast("array<string>")).alias("rejected")))
    rel = pg.with_relevance(good, pin, "url_id")
    pages_out = cut_lineage(pin.join(rel, "url_id"))
    links = pg.page_links(good, "url_id", "full_url")
    derived = pg.derived_links(links, pages_out, "url_id")

    # load
    refs = ld.build_references(pages_out, st.url, st.entity, as_of)
    reference_next = ld.append_references(st.reference, refs)
    entity_queue_next = ld.rejected_queue(st.entity_queue, pages_out, "drain_rank")
    # numbering goes on from what the state has given out, and from the batch if that is further
    last = discovered.agg(F.max("seq").alias("m")).unionByName(
        state.sequence.select((F.col("next_seq") - 1).alias("m"))).agg(F.max("m")).first()[0]
    start = 1 if last is None else int(last) + 1
    fb = ld.feedback(derived.join(pages_out.select("url_id", "drain_rank"), "url_id"),
                     [F.col("drain_rank"), F.col("is_homepage").desc(), F.col("url")], start)

    sequence_next = fb.agg((F.lit(start) + F.count(F.lit(1))).cast("long").alias("next_seq"))
    nxt = st.with_(url_queue=queue_next, reference=reference_next, entity_queue=entity_queue_next, sequence=sequence_next)
    rejected = pages_out.select(F.explode("rejected").alias("name")).distinct()
    changes |= {"url_queue": queue_next, "reference": refs, "sequence": sequence_next,
                "entity_queue": entity_queue_next.join(rejected, "name", "left_semi")}
    return RoundOutput(state=nxt, routed=routed, pages=pages_out, references=refs,
                       derived=derived, feedback=fb, changes=changes, gone={"url_queue": gone})
