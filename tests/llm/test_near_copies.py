"""One document of each class of near duplicates, without ids and with repeated ones."""

from ledgerloom.llm import near_duplicates
from tests.llm.samples import changed, prose


def test_one_row_of_each_class_stays(spark):
    near = [changed(prose(k, 120), k, 1) for k in range(4)]
    rows = [
        (None, prose(0, 120)), (None, near[0]),  # no id at all
        (3, prose(1, 120)), (None, near[1]),
        (5, prose(2, 120)), (4, near[2]), (5, prose(3, 120)), (6, near[3]),
    ]
    found = near_duplicates.without_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = lambda k: [r.doc_id for r in found if r.text in (prose(k, 120), near[k])]
    assert [of(k) for k in range(4)] == [[None], [3], [4], [5]]
