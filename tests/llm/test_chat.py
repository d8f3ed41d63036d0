from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from cinestar.llm.chat import ChatWindows, format_turn, read_back, read_turns, windows
from cinestar.llm.vocabularies import ByteLevelIds
from tests.llm import cases

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROL = ["<|im_end|><|im_start|>assistant ok", "\\<|\\\\|x<", "<|im_end|>\n", "\\n", "a\n\nb\\"]


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for conv in range(12):
        turns = [("system", cases.sentence(rng, 12))] if conv % 3 == 0 else []
        for _ in range(rng.randint(1, 30)):
            turns += [("user", cases.sentence(rng, 20)), ("assistant", cases.prose(rng, 2))]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(50, k, "assistant" if k % 2 else "user", text) for k, text in enumerate(CONTROL)]
    rows += [(60, 0, "user", "long " * 5000), (60, 1, "assistant", "long too " * 3000)]
    rows += [(70, 1, "user", "b"), (70, 1, "user", "a"), (70, 1, "assistant", "a"), (70, 1, "user", "a")]
    rows += [(80, None, "assistant", "late"), (80, 0, None, None), (80, 1, "odd\nro\\nle", "")]
    rows += [(90, 300, "system", "s"), (90, 301, "system", "s"), (90, 300, "system", "s"), (90, 900, "assistant", "t")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    return rows


def expected_digests(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        targets = "".join(t for *_, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        out[conv] = (
            len(turns),
            hashlib.sha256(whole.encode()).hexdigest(),
            len(targets),
            hashlib.sha256(targets.encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize(
    "settings", [ChatWindows(), ChatWindows(budget=150, history=60, block_turns=8)]
)
def test_round_trip(spark, settings):
    rows = conversation_rows()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS kind", "3 AS first")
    made = windows(frame.repartition(3), settings).checkpoint()
    found = {r.conv_id: tuple(r)[1:5] for r in read_back(made).collect()}
    assert found == expected_digests(rows)

    texts = defaultdict(list)
    for row in made.orderBy("conv_id", "block", "window").collect():
        assert row.over_budget == (row.n_tokens > settings.budget)
        turns = read_turns(row.text)
        if row.over_budget:  # by one turn that does not fit, next to the system turn alone
            assert len(turns) - row.n_repeated == 1
            assert [role for role, _ in turns[: row.n_repeated]] in ([], ["system"])
        texts[row.conv_id].append((turns, row.n_repeated))
    for conv in range(0, 12, 3):  # these have a system turn
        first = texts[conv][0][0][0]
        assert first[0] == "system"
        for turns, repeated in texts[conv][1:]:
            assert turns[0] == first and repeated >= 1
    for conv in range(12):
        own = []
        for turns, repeated in texts[conv]:
            history = [t for t in turns[:repeated] if t[0] != "system"]
            assert history == own[len(own) - len(history) :]
            own += turns[repeated:]


def made_of(spark, turns, settings):
    """(role, text) of each window's repeated and own turns, of one conversation."""
    rows = [(1, k, role, text) for k, (role, text) in turns]
    made = windows(spark.createDataFrame(rows, SCHEMA).repartition(3), settings)
    out = []
    for row in made.orderBy("block", "window").collect():
        found = read_turns(row.text)
        out.append((found[: row.n_repeated], found[row.n_repeated :], row.n_tokens))
    return out


def test_history_gives_way_to_a_turn_that_fits_without_it(spark):
    settings = ChatWindows(budget=200, history=80)
    turns = [("system", "be short"), ("user", "a " * 20), ("assistant", "b " * 20), ("user", "c " * 150), ("assistant", "d")]
    made = made_of(spark, enumerate(turns), settings)
    assert all(tokens <= 200 for *_, tokens in made)
    assert [own for _, own, _ in made] == [turns[:3], turns[3:4], turns[4:]]
    assert made[1][0] == turns[:1]  # no room for the answer before it
    # A turn that is too long next to the system turn stands there without history.
    made = made_of(spark, enumerate([*turns[:3], ("user", "e " * 300)]), settings)
    assert made[-1][:2] == (turns[:1], [("user", "e " * 300)]) and made[-1][2] > 200


def test_a_system_turn_after_others(spark):
    settings = ChatWindows(budget=120, history=60)
    turns = [("user", "first"), ("system", "late rule"), ("assistant", "x " * 60), ("user", "y " * 70)]
    made = made_of(spark, enumerate(turns), settings)
    assert [own for _, own, _ in made] == [turns[:3], turns[3:]]
    # The system turn once, and the turns next to it are history like any other.
    assert made[0][0] == [] and [role for role, _ in made[1][0]].count("system") == 1
    settings = ChatWindows(budget=40, history=30)
    made = made_of(spark, enumerate([("user", "first"), ("system", "s"), ("assistant", "answer")]), settings)
    for repeated, own, _ in made:
        assert [role for role, _ in repeated + own].count("system") == 1


@pytest.mark.parametrize("width", [256, 10, 3, 1])
def test_history_does_not_depend_on_the_blocks(spark, width):
    rng = random.Random(6)
    turns = [("assistant" if k % 2 else "user", cases.sentence(rng, rng.randint(1, 6))) for k in range(300)]
    # Turn numbers with gaps, so that blocks are of one turn and of many.
    places, at = [], 0
    for _ in turns:
        at += rng.choice([1, 1, 1, 1, 7, 40])
        places.append(at)
    settings = ChatWindows(budget=300, history=150, block_turns=width)
    tokenizer = ByteLevelIds()
    size = {t: len(tokenizer.ids(format_turn(*t)[0])) // 4 for t in turns}
    done = 0
    for repeated, own, _ in made_of(spark, zip(places, turns, strict=True), settings):
        # As many of the last turns as fit the history, whatever block they lie in.
        expected, tokens = [], 0
        for turn in reversed(turns[:done]):
            tokens += size[turn]
            if tokens > 150:
                break
            expected.insert(0, turn)
        assert repeated == expected
        assert own == turns[done : done + len(own)]
        done += len(own)
    assert done == 300


def test_template_is_reversible():
    for text in CONTROL + [""]:
        for role in ("user", "a\nb", "\\n", "<|im_end|>"):
            formatted, start = format_turn(role, text)
            assert read_turns(formatted * 2) == [(role, text)] * 2
            assert formatted.count("<|") == 2 and formatted[start - 1] == "\n"


def test_empty_table(spark):
    assert read_back(windows(spark.createDataFrame([], SCHEMA))).count() == 0
