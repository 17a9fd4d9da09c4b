"""Conversation repair against a plain search, with segments so small that conversations cross many."""

import hashlib
import itertools
import random

import pytest

from orfloom.llm.conversations import Repair, _segment_audits, joined_digests, least_paths, optimal_arcs

ROWS = "conv_id long, turn long, role string, text string, conv string, nr int, cost int"


def plain(rows):
    """Everything of one conversation, from a recursion over (row, state) that compares whole audits."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    to = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    end = {0: (0, "", ()), 1: (4, "II", ("user:", "assistant:")), 2: (2, "I", ("assistant:",)), 3: (0, "", ())}
    for (_, role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        found = {}
        for q in range(4):
            ways = [(3 + end[q][0], "D" + end[q][1], end[q][2])]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((q, role[:1]))
                if keep:
                    ways.append((cut + end[keep][0], "K" + end[keep][1], (f"{role}:{text}", *end[keep][2])))
                ways.append((2 + cut + end[to[q]][0], "R" + end[to[q]][1], (f"{name[to[q]]}:{text}", *end[to[q]][2])))
            found[q] = min(ways)
        for _ in range(3):
            for q in range(4):
                cost, audit, lines = found[to[q]]
                found[q] = min(found[q], (2 + cost, "I" + audit, (f"{name[to[q]]}:", *lines)))
        end = found
    cost, audit, lines = end[0]
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def found(spark, rows, **how):
    df = spark.createDataFrame([(c, t, r, x, "z", 1, 2) for c, t, r, x in rows], ROWS).repartition(3)
    repair = Repair(df, **how)
    counts = {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"]) for r in repair.counts().collect()}
    audits = {r["conv"]: (r["cost"], r["audit"]) for r in repair.audits().collect()}
    digests = {r["conv"]: r["sha256"] for r in joined_digests(repair.repaired()).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {c: (*counts[c], *audits[c], digests.get(c, empty)) for c in counts}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "So? ", "a\nb.", None, "x . ", "Done. "]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            turn = rng.choice([t, t, t, t + 1, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows += [(c if c else None, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randint(0, 9)}.")] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("segment", [3, 4096])
def test_repair_equals_plain_search(spark, segment):
    rows = random_rows(segment, 60, 14)
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((t, r, x))
    assert found(spark, rows, segment=segment) == {c: plain(v) for c, v in want.items()}


def test_long_conversation_of_many_segments(spark):
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"T{rng.randint(0, 400)}" + rng.choice([".", ".", ""])) for t in range(900)]
    rows += [(7, 900, "user", "same.")] * 200 + [(8, 0, "user", "w " * 50_000)]
    want = {c: plain([r[1:] for r in rows if r[0] == c]) for c in (7, 8)}
    assert found(spark, rows, segment=100) == want


def test_empty_table_and_rows_that_all_go(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None, None, None), (1, 5, None, "")]) == {1: plain([(None, None, None), (5, None, "")])}


def test_extreme_turns_do_not_overflow(spark):
    rows = [(1, -(2**63), "user", "A."), (1, 2**63 - 1, "assistant", "B.")]
    assert found(spark, rows)[1][0] is None and found(spark, rows)[1][5:7] == (0, "KK")


def test_ranks_list_the_least_of_all_cheapest_audits():
    rng = random.Random(3)
    end = (0, 4, 2, 0)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 9]) for _ in range(rng.randint(0, 7)))
        arcs, _ = optimal_arcs(codes, list(end), True)

        def audits(node, arcs=arcs):
            out = [""] if (arcs[node] < 0).all() else []
            for letter, to in enumerate(arcs[node].tolist()):
                if to >= 0:
                    out += ["DIKR"[letter] + rest for rest in audits(to)]
            return out

        import numpy as np

        starts = np.arange(4)
        assert [t.decode() for t in least_paths(arcs, starts)[0]] == [min(audits(q)) for q in range(4)]
        assert _segment_audits([(codes, [0 if i % 5 == 0 else 1 << 40 for i in range(16)], 1, 1)])[0][2] == [min(audits(0))]
