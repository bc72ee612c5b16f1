"""newsflow: clean, profile, featurize, train and score short texts on Spark.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function built
from Spark SQL expressions, Spark ML stages and Structured Streaming; there is
no per-row Python in the data path.
"""

from newsflow.session import get_spark, stage

__all__ = ["get_spark", "stage"]
