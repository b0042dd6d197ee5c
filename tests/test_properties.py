"""Properties of the whole chain on generated feeds, over stored tables."""

import random

import pytest

from tests.build import BOOKING, CLAIM, RESERVATION, raw, same_rows
from tidemark import constants as K
from tidemark.plans import gold
from tidemark.specs import SAFE, Policy
from tidemark.streaming.flow import Flow

SEEDS = [1, 2, 3]


def generated(seed):
    """Changes of the three entities in log order, with hot keys, deletes and moved children."""
    rng = random.Random(seed)
    keys = ["hot"] * 4 + [f"b{n}" for n in range(6)]
    feed = []
    for seq in range(1, 61):
        op = rng.choice("IUUUD")
        booking = rng.choice(keys)
        kind = rng.choice(["booking", "reservation", "claim"])
        row = {"op": op, "seq": str(seq)}
        if kind == "booking":
            row |= {"id": booking, "BOOKING_STATUS": rng.choice(["CONFIRMED", "PENDING", "CANCELLED", None]),
                    "FARE_AMOUNT": rng.choice(["100", "950.50", "1300", "x"])}
        elif kind == "reservation":
            row |= {"id": f"r{rng.randrange(6)}", "BOOKING_ID": booking, "CHECKED_IN_FLAG": rng.choice(["Y", "N", None])}
        else:
            row |= {"id": f"c{rng.randrange(8)}", "BOOKING_ID": rng.choice([booking, None]),
                    "CLAIM_STATUS": rng.choice(["OPEN", "SETTLED", "REJECTED"]), "CLAIM_AMOUNT": rng.choice(["10", "200.25"])}
        feed.append((kind, row))
    return feed


def parts(feed, rng, n):
    """The feed cut at random places."""
    cuts = sorted(rng.sample(range(1, len(feed)), n - 1))
    return [feed[a:b] for a, b in zip([0, *cuts], [*cuts, len(feed)])]


def run(spark, path, batches, run_ts, policy: Policy = SAFE, refresh=True):
    flow = Flow(spark, str(path), "", policy, run_ts=run_ts)
    for batch in batches:
        given = {}
        for spec in (BOOKING, RESERVATION, CLAIM):
            rows = [r for kind, r in batch if kind == spec.name]
            if rows:
                given[spec] = raw(spark, spec, *rows)
        flow.merge_all(given)
        if refresh:
            flow.refresh_gold()
    return flow


def states(flow):
    return {n: sorted(map(str, t.read().collect())) for n, t in flow.silver.items()}


def rebuilt(flow, run_ts):
    silver = [flow.silver[n].read() for n in ("booking", "reservation", "claim")]
    return gold.booking_fact(*silver, run_ts=run_ts)


@pytest.mark.parametrize("seed", SEEDS)
def test_splits_order_and_repeats_do_not_matter(spark, tmp_path, run_ts, seed):
    rng, feed = random.Random(seed), generated(seed)
    whole = run(spark, tmp_path / "whole", [feed], run_ts)
    batches = parts(feed, rng, 3)
    split = run(spark, tmp_path / "split", batches, run_ts)
    shuffled = run(spark, tmp_path / "shuffled", [batches[2], batches[0], batches[1], batches[0]], run_ts)
    assert states(whole) == states(split) == states(shuffled)
    for flow in (whole, split, shuffled):
        assert same_rows(flow.fact.read(), rebuilt(flow, run_ts))


@pytest.mark.parametrize("seed", SEEDS[:2])
def test_large_batch_paths_agree(spark, tmp_path, run_ts, seed, monkeypatch):
    """The shuffled ways, taken when nothing may be broadcast, end in the same tables."""
    rng, feed = random.Random(seed), generated(seed)
    batches = parts(feed, rng, 2)
    small = run(spark, tmp_path / "small", batches, run_ts)
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    large = run(spark, tmp_path / "large", batches, run_ts)
    assert states(small) == states(large)
    assert same_rows(small.fact.read(), large.fact.read())


def test_unguarded_equals_guarded_in_order(spark, tmp_path, run_ts):
    feed = generated(7)
    batches = parts(feed, random.Random(7), 3)
    guarded = run(spark, tmp_path / "g", batches, run_ts, refresh=False)
    plain = run(spark, tmp_path / "p", batches, run_ts, Policy(guard=False), refresh=False)
    assert states(guarded) == states(plain)
