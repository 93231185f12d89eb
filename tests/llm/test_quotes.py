"""Quotation linking against brute force, with lines that many messages have."""

import random
from itertools import groupby

from millrace.llm import quotes

LINES = ["Thanks", "Yes", "See below", "alpha beta", "gamma", "delta", "-- J", "nobody wrote"]


def brute_force(messages):
    """reply_to and outside_thread by (thread, position)."""
    parsed = {
        at: [(len(x) - len(x.lstrip(">")), x.lstrip(">").strip()) for x in text.split("\n")]
        for at, text in messages.items()
    }
    own = {at: [line for level, line in lines if level == 0] for at, lines in parsed.items()}

    def latest(at, run):
        earlier = [p for t, p in own if t == at[0] and p < at[1] and any(
            own[t, p][i : i + len(run)] == run for i in range(len(own[t, p])))]
        return max(earlier, default=None)

    found = {}
    for at, lines in parsed.items():
        links, outside = [], 0
        for level, run in groupby(lines, lambda x: x[0]):
            run = [line for _, line in run]
            if level and (up := latest(at, run)) is not None:
                links.append((level, 0, -up))
            for line in run if level else ():
                if (up := latest(at, [line])) is not None:
                    links.append((level, 1, -up))
                else:
                    outside += any(line in rows for (t, _), rows in own.items() if t != at[0])
        found[at] = (-min(links)[2] if links else None, outside)
    return found


def test_links_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quotes, "CHUNK_BITS", 2)
    rng = random.Random(7)
    messages = {
        (1, 1): "Thanks\nYes",
        (1, 3): "alpha beta\nThanks",
        (1, 4): "> alpha beta\n> Thanks\nok",  # of 3, whose last line stands in 1 too
        (1, 5): "> Later here\nfine",  # only 6 and thread 2 have it
        (1, 6): "Later here",
        (2, 1): "Later here",
    }
    for thread in (3, 4, 5):
        for position in range(14):
            parts = [mark + line for mark in rng.choices(["", "", "> ", ">> "], k=3)
                     for line in rng.choices(LINES[:-1] if mark == "" else LINES, k=rng.randint(1, 3))]
            messages[thread, position] = "\n".join(parts)
    rows = [(*at, text) for at, text in messages.items()]
    df = spark.createDataFrame(rows, "thread long, position long, text string")
    found = {
        (r["thread"], r["position"]): (r["reply_to"], r["outside_thread"])
        for r in quotes.link_quotes(df).collect()
    }
    assert found == brute_force(messages)
    assert found[1, 4] == (3, 0) and found[1, 5] == (None, 1)
