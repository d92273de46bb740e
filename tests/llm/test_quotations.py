"""Quotations that are wrapped anew, cut, nested, short, repeated or none at all, against plain Python."""

import random
import textwrap

from pyspark.sql import functions as F

from gridfill.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"
LONG = "The river rose all night, and by the morning nobody could cross the old wooden bridge. We waited for the boats until noon. Then it rained."


def threaded(spark, talk):
    messages = spark.createDataFrame([(c, t, "u", text) for c, t, text in talk], SCHEMA)
    return {(r.conv_id, r.turn): (r.parent_turn, r.text, r.n_quoted) for r in quotes.thread_conversations(messages).collect()}


def quoted(text, width, marks="> "):
    return "\n".join(marks + line for line in textwrap.wrap(text, width))


def test_wrapped_anew_and_cut(spark):
    talk = [(1, 0, LONG), (1, 1, "Nothing to see here, I only pass by."), (1, 2, quoted(LONG, 30) + "\nSo sad."),
            (1, 3, "> We waited for the boats until noon.\nDid you?"), (1, 4, "> Then it rained.\nIt did."),
            (1, 5, "On Tuesday someone wrote:\n" + quoted("So sad.", 40) + "\n" + quoted(LONG, 50, ">> ") + "\nIndeed.")]
    got = threaded(spark, talk)
    assert got[1, 2] == (0, "So sad.", len(textwrap.wrap(LONG, 30)))
    assert got[1, 3] == (0, "Did you?", 1)
    assert got[1, 4] == (0, "It did.", 1)
    assert got[1, 5][0] == 2 and got[1, 5][1] == "Indeed."


def test_lines_that_quote_nothing_stay(spark):
    talk = [(1, 0, "Please try it."), (1, 1, "> not a quote but a shell prompt\n>>> x = 5\nworks"), (1, 2, "> Please try it.\n\n> make all the tests pass again\ndone"),
            (2, 0, LONG), (3, 0, "x"), (3, 1, quoted(LONG, 40) + "\nfrom elsewhere")]
    got = threaded(spark, talk)
    assert got[1, 1] == (0, talk[1][2], 0)
    assert got[1, 2] == (0, "> make all the tests pass again\ndone", 1)
    assert got[3, 1] == (0, talk[5][2], 0)  # said in another conversation only


def test_ties_and_very_long_texts(spark):
    text = " ".join(f"w{i % 991}x{i}" for i in range(40_000))
    talk = [(1, 0, text), (1, 1, text), (1, 2, "short one"), (1, 3, quoted(text, 70) + "\nyes"), (1, 4, None), (1, 5, "> " + text.upper())]
    got = threaded(spark, talk)
    assert got[1, 3][:2] == (1, "yes")  # of equal sources the latest
    assert got[1, 5][:2] == (1, "")


def grams(said):
    return {tuple(said[i:i + quotes.WINDOW]) for i in range(max(1, len(said) - quotes.WINDOW + 1))} if said else set()


def own_grams(text):
    out = set()
    for level, _, _, lines in quotes.runs(text):
        if level == 0:
            out |= grams(quotes.words("\n".join(lines)))
            for line in lines:
                for part in [line, *quotes._SENTENCE.split(line)]:
                    said = quotes.words(part)
                    if len(said) < quotes.WINDOW:
                        out |= grams(said)
    return out


def brute(talk):
    """``(conv, turn, run) -> (source, grams found there)``, message by message."""
    out = {}
    for conv, turn, text in talk:
        for number, (level, _, _, lines) in enumerate(quotes.runs(text)):
            asked = grams(quotes.words("\n".join(lines))) if level else set()
            votes = {}
            for gram in asked:
                holders = [t for c, t, other in talk if c == conv and t < turn and gram in own_grams(other)]
                if holders:
                    votes[max(holders)] = votes.get(max(holders), 0) + 1
            if asked and 2 * sum(votes.values()) >= len(asked):
                n, source = max((n, t) for t, n in votes.items())
                out[conv, turn, number] = (source, n)
    return out


def test_random_talk(spark):
    pick = random.Random(4)
    vocabulary = [f"word{i}" for i in range(25)]
    talk = []
    for conv in range(4):
        said = []
        for turn in range(25):
            lines = []
            if said and pick.random() < 0.7:
                words = pick.choice(said).split()
                start = pick.randrange(len(words))
                part = words[start:start + pick.randint(1, 20)]
                if pick.random() < 0.3:
                    part[pick.randrange(len(part))] = "changed"
                lines.append(quoted(" ".join(part), pick.choice((15, 40, 200)), pick.choice(("> ", ">> ", "> > "))))
            if pick.random() < 0.2:
                lines.append("> " + " ".join(pick.choices(vocabulary, k=4)))
            own = " ".join(pick.choices(vocabulary, k=pick.randint(1, 40)))
            said.append(own)
            lines.append(textwrap.fill(own, 50))
            pick.shuffle(lines)
            talk.append((conv, turn, "\n".join(lines)))
    messages = spark.createDataFrame([(c, t, "u", text) for c, t, text in talk], SCHEMA)
    got = {(r.conv, r.turn, r.run): (r.source, r.n_found) for r in quotes.find_quotations(messages).collect()}
    want = brute(talk)
    assert got == want and len(want) > 30


def test_blocks_of_turns(spark):
    # sources many blocks of turns back
    n = 3 * quotes.BLOCK
    chat = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
                                 F.when(F.col("id") == n - 1, "> here is the very first thing to say\nok").when(F.col("id") == 2, "Here is the very first thing to say!")
                                 .otherwise(F.concat(F.lit("chatter "), "id")).alias("text"))
    assert [(r.turn, r.level, r.source_turn) for r in quotes.link_quotes(chat).collect()] == [(n - 1, 1, 2)]
