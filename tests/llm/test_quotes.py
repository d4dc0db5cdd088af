"""Quotes that templates alone do not tell."""
import pytest

from fareforge.llm import decontaminate

NUMBERS = " ".join(str(k * k + 17) for k in range(30))
TITLE = "The Old Man Went Down To The River And Saw A Boat With Seven White Sails Near The Far Bank"
LONG = ("Anna has 7 apples and 7 pears. " + "the farmer walks along the green road until the small house by the lake comes into "
        "view and then turns back to the village before it is dark")
SHORT = "3 4 5 6 7 8 9 10 11"


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_literal_quotes(spark, limit):
    texts = {1: NUMBERS, 2: f"Some words before {NUMBERS} and after", 3: TITLE, 4: TITLE.lower(), 5: TITLE.upper(),
             6: LONG.replace("7 pears", "8 pears"), 7: "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18", 8: None,
             9: " ".join(str(k * k + 18) for k in range(30)), 10: "The Cat Sat On The Mat And Did Not Go Away All Day",
             11: f"count {SHORT} up", 12: "3 4 5 6 7 8 9 12 11"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, NUMBERS), (2, TITLE), (3, LONG), (4, SHORT)], "item_id long, text string")
    got = {r.doc_id: r.items for r in decontaminate.leaks(docs, bench, limit).collect()}
    assert got == {1: "1", 2: "1", 3: "2", 4: "2", 5: "2", 6: "3", 7: "4", 11: "4"}
