"""Registered evaluation queries (M9-M11) on a deterministic (label, prediction) pair.

label = ``lang``; prediction = ``lang`` except for documents in a 20 % hash
bucket (seed 7), which get the next language in alphabetical order (cyclic).
This exercises every metric, including the zero cells of the matrix, with a
result both engines can state exactly.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsflow.operators import metrics as M
from newsflow.operators.features import is_test, label_index
from newsflow.sources.tables import read_table


def pairs(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    li = label_index(docs, "lang")
    order = Window.orderBy("label_idx")
    nxt = li.select("lang", F.coalesce(F.lead("lang").over(order), F.first("lang").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_lang"))
    # one row a class
    j = docs.join(F.broadcast(nxt), "lang")
    return j.select("doc_id", F.col("lang").alias("label"),
                    F.when(is_test("doc_id", seed=7), F.col("next_lang"))
                    .otherwise(F.col("lang")).alias("prediction"))


def q_accuracy(spark, sf):
    return M.accuracy(pairs(spark, sf)).select("n", F.round("accuracy", 6).alias("accuracy"))


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(pairs(spark, sf))


def q_classification_report(spark, sf):
    return M.classification_report(pairs(spark, sf))


QUERIES = {
    "accuracy": q_accuracy,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
}

_PAIRS = """
li AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS idx
       FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
k AS (SELECT count(*) AS k FROM li),
p AS (SELECT d.doc_id, d.lang AS label,
             CASE WHEN substr(md5(concat('7:', CAST(d.doc_id AS VARCHAR))), 1, 8) < '33333333'
                  THEN n.lang ELSE d.lang END AS prediction
      FROM documents d JOIN li a ON d.lang = a.lang CROSS JOIN k
      JOIN li n ON n.idx = (a.idx + 1) % k.k),
cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p),
cm AS (SELECT a.c AS label, b.c AS prediction, CAST(count(p.doc_id) AS BIGINT) AS n
       FROM cls a CROSS JOIN cls b
       LEFT JOIN p ON p.label = a.c AND p.prediction = b.c GROUP BY a.c, b.c)"""

_REPORT = f"""WITH {_PAIRS},
pc AS (SELECT l.label AS class_name, l.tp, l.support, r.predicted FROM
       (SELECT label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp, sum(n) AS support
        FROM cm GROUP BY label) l
       JOIN (SELECT prediction, sum(n) AS predicted FROM cm GROUP BY prediction) r
       ON l.label = r.prediction),
sc AS (SELECT class_name, tp, support,
              CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
sf AS (SELECT *, CASE WHEN precision + recall > 0
                      THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM sc)
SELECT class_name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM sf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM sf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM sf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM sf"""

SQL = {
    "accuracy": f"WITH {_PAIRS} SELECT count(*) AS n, "
                f"round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p",
    "confusion_matrix": f"WITH {_PAIRS} SELECT label, prediction, n FROM cm",
    "classification_report": _REPORT,
}
