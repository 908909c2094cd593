import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from tessera.plans import jobs as J
from tessera.plans.io_jobs import movie_lines, rating_lines
from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.sources.tables import movies, ratings
from support import SF_SMALL, rows


@pytest.fixture(scope="module")
def files(spark):
    d = tempfile.mkdtemp(prefix="jobs-")
    rating_lines(spark, SF_SMALL).write.text(f"{d}/u.data")
    movie_lines(spark, SF_SMALL).write.text(f"{d}/u.item")
    return d


def test_similarity_then_prediction_job(spark, files):
    out = J.similarity_job(spark, f"{files}/u.data", f"{files}/sim")
    assert out.count() == S.similarity(ratings(spark, SF_SMALL)).count() > 0
    with pytest.raises(AnalysisException):
        J.similarity_job(spark, f"{files}/u.data", f"{files}/sim", mode="errorifexists")
    pred = J.prediction_job(spark, f"{files}/u.data", f"{files}/u.item", f"{files}/sim")
    r = ratings(spark, SF_SMALL)
    exp = rows(P.predictions(r, S.similarity(r), movies(spark, SF_SMALL)))
    assert rows(pred) == exp
    assert rows(J.lazy_predictions(spark, f"{files}/u.data", f"{files}/u.item")) == exp


def test_word_count_and_column_correction_jobs(spark):
    d = tempfile.mkdtemp(prefix="jobs-")
    with open(f"{d}/in.txt", "w") as f:
        f.write("a  b\n c\n\n   \n")
    res = J.word_count_job(spark, f"{d}/in.txt", f"{d}/words")
    assert res == {"lines": 4, "words": 6}
    assert sorted(r.value for r in spark.read.text(f"{d}/words").collect()) == ["", "", "", "a", "b", "c"]
    with open(f"{d}/cols.txt", "w") as f:
        f.write("1,a_b,3\n,x_y,z\n")
    out = J.column_correction_job(spark, f"{d}/cols.txt", f"{d}/fixed")
    assert sorted(r.value for r in out.collect()) == ["1,a b,3", "x y,z"]
