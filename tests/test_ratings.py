import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions import ratings

CASES = [
    (ratings.rate_ks, [(0.50, "卓越"), (0.40, "優秀"), (0.20, "許容"), (0.19, "分離能不足"), (None, "分離能不足")]),
    (ratings.rate_iv, [(0.50, "過学習疑い"), (0.30, "強い予測力"), (0.10, "中程度"), (0.02, "弱い予測力"), (0.01, "無効変数")]),
    (ratings.rate_cliffs, [(-0.474, "Large"), (0.33, "Medium"), (-0.147, "Small"), (0.146, "Negligible")]),
    (ratings.rate_z, [(-3.0, "有意 (参考)"), (2.99, "参考値未満")]),
    (ratings.rate_pr_auc, [(0.80, "PASS"), (0.79, "FAIL")]),
    (ratings.rate_capture_0_1, [(0.75, "PASS"), (0.74, "FAIL")]),
    (ratings.rate_capture_0_5, [(0.90, "PASS"), (0.89, "FAIL")]),
    (ratings.rate_psi, [(0.09, "Green"), (0.10, "Yellow"), (0.25, "Red"), (None, "Red")]),
]


@pytest.mark.parametrize("rate,cases", CASES, ids=[rate.__name__ for rate, _ in CASES])
def test_borders(spark, rate, cases):
    df = spark.createDataFrame(list(enumerate(v for v, _ in cases)), "i int, v double")
    got = [r.rating for r in df.select("i", rate(F.col("v")).alias("rating")).orderBy("i").collect()]
    assert got == [label for _, label in cases]
