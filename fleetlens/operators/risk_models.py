"""Risk classifier, learned slope prior and their measures, with Spark ML."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, RobustScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def preprocessing(numeric: list[str], categorical: list[str]) -> list:
    """M-2: medians for missing numbers, centred and scaled by quartiles; unseen categories kept apart, one-hot."""
    filled = [f"{c}_filled" for c in numeric]
    steps = [Imputer(strategy="median", inputCols=numeric, outputCols=filled)]
    for c in categorical:
        steps += [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_hot", handleInvalid="keep")]
    steps += [VectorAssembler(inputCols=filled, outputCol="numbers", handleInvalid="keep"), RobustScaler(inputCol="numbers", outputCol="scaled", withCentering=True)]
    return [*steps, VectorAssembler(inputCols=["scaled", *[f"{c}_hot" for c in categorical]], outputCol="features", handleInvalid="keep")]


def train_classifier(rows: DataFrame, numeric: list[str], categorical: list[str], label: str = "label", trees: int = 20):
    """M-3: a balanced random forest; None where only one class or fewer than ten rows are there."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if len(counts) < 2 or sum(counts.values()) < 10:
        return None
    total = sum(counts.values())
    weight = F.when(F.col(label) == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0]))
    forest = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=6, seed=42)
    return Pipeline(stages=[*preprocessing(numeric, categorical), forest]).fit(rows.withColumn("weight", weight))


def risk(model, rows: DataFrame) -> DataFrame:
    """M-4: probability times 100."""
    return model.transform(rows).withColumn("model_risk", 100 * vector_to_array("probability")[1])


def risk_of_anomaly(decision: Column) -> Column:
    """M-4 where no classifier could be trained: an isolation forest's decision value (low: anomalous) as 0 to 100."""
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), (0.12 - decision) / 0.24 * 100))


def save_models(models: dict[str, PipelineModel], path: str) -> None:
    """S-13: one folder per category below a shared path; earlier models of these categories are replaced."""
    for category, model in models.items():
        model.write().overwrite().save(f"{path}/{category}")


def load_models(path: str, categories: list[str]) -> dict[str, PipelineModel]:
    """S-13."""
    return {c: PipelineModel.load(f"{path}/{c}") for c in categories}


def area_under_roc(scored: DataFrame, score: str, label: str = "label") -> float:
    """A-21: exact (no bins), ties count half."""
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, numBins=0).evaluate(scored)


def classifier_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    """A-21: accuracy, majority baseline, precision, recall and F1, from four counts."""
    hit = lambda a, b: F.sum(((F.col("prediction") == a) & (F.col(label) == b)).cast("double"))
    c = scored.agg(hit(1, 1).alias("tp"), hit(1, 0).alias("fp"), hit(0, 1).alias("fn"), hit(0, 0).alias("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    p, r = F.col("tp") / F.greatest(F.lit(1.0), F.col("tp") + F.col("fp")), F.col("tp") / F.greatest(F.lit(1.0), F.col("tp") + F.col("fn"))
    return c.select(n.alias("n"), ((F.col("tp") + F.col("tn")) / n).alias("accuracy"), F.greatest((F.col("tp") + F.col("fn")) / n, (F.col("tn") + F.col("fp")) / n).alias("majority"), p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"))


def train_slope_prior(table: DataFrame, least: int = 30):
    """T-26: predicts the normalised slope from context; None with fewer than `least` rows."""
    if table.limit(least).count() < least:
        return None
    return Pipeline(stages=[*preprocessing(["latest", "n"], ["rtype", "feature"]), GBTRegressor(labelCol="norm_slope", maxIter=10, maxDepth=3, seed=42)]).fit(table.withColumn("n", F.col("n").cast("double")))
