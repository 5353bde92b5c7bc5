"""Leaks that windows of plain words, one-to-one slots and coverage alone would miss."""

import pytest
import xxhash
from test_search_and_archives import ITEM
from tideline.llm import decontaminate

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()
LONG = " ".join(f"{a}{b}" for a in WORDS for b in WORDS[:4])


def keys(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r[0], r[1]) for r in decontaminate.find(df, bench, strict=False).collect()}


def test_items_of_placeholders_capitals_and_few_words(spark):
    items = [(1, "What is 17 * 23 + 45?"), (2, "Compute 12 * 34 + 5 - 6"), (3, "The Art Of Very Long Walks"), (4, "just three words"), (5, ITEM)]
    docs = [
        (1, "So, what now. What is 17 * 23 + 45? Think."), (2, "please compute 12 * 34 + 5 - 6 now"),
        (3, "I read The Art Of Very Long Walks today"), (30, "i read the art of very long walks today"),
        (4, "here are just three words inside"), (5, "Ask. " + ITEM.upper()), (9, "What is 18 * 24 + 46? just three or four words"),
    ]
    assert keys(spark, docs, items) == {(1, 1), (2, 2), (3, 3), (30, 3), (4, 4), (5, 5)}


def test_slots_need_not_be_one_to_one(spark):
    docs = [(1, ITEM.replace("at 9", "at 5")), (2, ITEM.replace("120", "4").replace("30", "4")), (3, ITEM.replace("at 9", "at 5").replace("if 9", "if 6"))]
    assert keys(spark, docs, [(1, ITEM)]) == {(1, 1), (2, 1), (3, 1)}


def test_a_long_run_counts_whatever_its_share(spark):
    words = LONG.split()
    docs = [(1, "so " + " ".join(words[20:33]) + " end"), (2, "so " + " ".join(words[20:32]) + " end")]
    assert keys(spark, docs, [(1, LONG)]) == {(1, 1)}


@pytest.mark.parametrize("strict", [True, False])
def test_minority_replacements_are_left_out(strict):
    slots = ["0:1a", "0:1a", "0:1a", ""]
    assert decontaminate.judge([0, 5, 9, 12], slots, ["0:1b", "0:1b", "0:1c", ""], 5, strict) == ([0, 5, 12], 5, False)
    assert decontaminate.judge([0, 5], slots[:2], ["0:1b", "0:1c"], 5, strict)[0] == ([] if strict else [0])


def test_leaks_go_by_row(spark):
    docs = spark.createDataFrame([(None, ITEM, 1), (1, ITEM, 2), (1, "clean text", 3), (None, "clean", 4)], "doc_id long, text string, h int")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(r["h"] for r in decontaminate.without_leaks(docs, bench).collect()) == [3, 4]


def test_stretches_are_learned_all_at_once_like_one_by_one():
    texts = ["Ends here. Ünder ²x x² ΑΣ ΑΣ.Β 3.5kg 1,000.25, $5 a_b '…' – (so!) \"Why?\" ½ İi", "", "ends HERE. ǅ 12 kg. ΑΣ ٣٤ _ x:"]
    once = decontaminate.Templates(most=3)
    for text in [*texts, *texts]:  # the second time after clearing
        chunks = text.split()
        rows = once.rows([chunks])
        (first, count), (kind, unit, value, end) = once.of_chunks, once.of_tokens
        for chunk, row in zip(chunks, rows):
            some = decontaminate.TOKEN.findall(chunk)
            at = range(first[row], first[row] + count[row])
            assert [once.token[i] for i in at] == some
            assert [int(kind[i]) for i in at] == [2 if t[0].isdigit() else 1 if t[0].isupper() else 0 for t in some]
            assert [int(value[i]) for i in at] == [xxhash.xxh64_intdigest(t.lower()) | 7 for t in some]
            assert [bool(unit[i]) for i in at] == [t.lower() in decontaminate.UNITS for t in some]
            closed = chunk.rstrip("\"')]}»”’")[-1:] in tuple(".!?…:")
            assert [bool(end[i]) for i in at] == [False] * (len(some) - 1) + [closed] * bool(some)
