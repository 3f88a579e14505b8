import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: Nulls, empties, ties, repeated rows and long texts that every operator must take.
ODD_TEXTS = [
    (1, "the cat sat on the mat and looked at the moon for a while"),
    (2, "the cat sat on the mat and looked at the moon for a while"),
    (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "one two"), (7, "one two"),
    (8, "a b c " * 40), (9, "x" * 70000), (10, "word " * 20000), (None, "no id here at all"),
    (11, "ÀÉ ünïcode ▁ text   with odd \x0b space\x00nul"), (12, "!!! ??? 123 ..."),
]


@pytest.fixture(scope="session")
def spark():
    from duetlog.session import get_session
    return get_session("local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", f"src{n % 3}", n, 1.5) for n, (i, t) in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key int, fp double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
