"""Languages that the first documents of the sample do not hold."""

from pyspark.sql import functions as F

import cases
from reviewmill.llm import langid


def test_rare_language_is_learned(spark):
    common = [(i, cases.passage(i, 20), "aa", None, None) for i in range(400)]
    rare = [(1000 + i, "zwölf größere bäume würden überall blühen " * 3, "zz", None, None) for i in range(8)]
    docs = cases.frame(spark, common + rare)
    fold = langid.common.fold(F.col("doc_id"), langid.FOLDS)
    first = docs.filter(fold != langid.HELD).orderBy(F.xxhash64("doc_id"), "doc_id").limit(12)
    assert not first.filter("lang = 'zz'").count()
    model = langid.fit(docs, sample=12, rounds=1)
    assert model.languages == ["aa", "zz"]
    got = langid.predict(docs.filter("lang = 'zz'"), model).collect()
    assert {r["lang_pred"] for r in got} == {"zz"}


def test_number_signs_are_no_letters():
    assert [langid.words_of(x) for x in ("½ ² ①", "Ⅷ", "²", "x² Ⅷa 3b_c", "ﬀ ª")] == [[], [], [], ["x", "a", "b", "c"], ["ﬀ", "ª"]]
