"""Few labels reject nothing; the packing takes ids of any partition number."""

import numpy as np

from clickvault.llm import bestfit, cotrain
from test_brute import awkward


def test_one_kind_of_label_rejects_nothing(spark):
    docs = awkward(spark)
    for rows in ([(7, 0)], [(i, 0) for i in range(1, 14)], [(1, 1), *[(i, 0) for i in range(2, 14)]]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert cotrain.score(docs, labels).where("not kept").count() == 0
        assert cotrain.keep_documents(docs, labels).count() == docs.count()


def test_rare_class_is_in_both_parts():
    for n in (2, 3, 5, 9):
        for at in range(4):
            y = np.zeros(80)
            y[at : at + 4 * n : 4] = 1
            fold = cotrain._calibration_fold(y)
            assert len({*y[fold]}) == len({*y[~fold]}) == 2


def test_packing_ids_of_many_partitions(spark):
    sizes = [int(s) for s in np.random.default_rng(3).integers(1, 900, 400)]
    packed = []
    for shift in (0, 2_000_000 << 40):
        items = spark.createDataFrame([(shift + i, s) for i, s in enumerate(sizes)], "uid long, length long")
        got = bestfit.best_fit(items, 1024).collect()
        packed.append({(r.uid - shift, r.bin - shift, r.offset) for r in got})
    assert packed[0] == packed[1] and len(packed[0]) == 400
