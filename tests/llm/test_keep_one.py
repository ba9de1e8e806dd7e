"""Which rows stay of near-duplicates when ids and texts repeat."""

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pulseboard.llm import simhash  # noqa: E402

P = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree at night."
U = "Entirely other words stand in this second text and nothing of it is shared with anything else here."


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    rows = [(1, P, "a"), (9, P, "b"), (9, U, "c"), (9, U, "d"), (9, U, "d"), (None, P, "e"), (None, P, "f"), (12, U, "g"), (None, "x y z", "h"), (3, None, "i"), (4, "", "j")]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got = Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect())
        assert got == Counter([(1, P), (9, U), (None, P), (None, P), (None, "x y z"), (3, None)])
    # The same one of the repeated rows each time.
    assert len({r["source"] for _ in range(3) for r in simhash.keep_one(docs.repartition(3)).where(docs["text"] == U).collect()}) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0
