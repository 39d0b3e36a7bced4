"""Noun marks for keyword extraction: a small tagger, trained here by counting.

A token is described by its word, its last three and last two letters, and the
words before and after it.  Training counts each description among noun and
other tokens of a marked table (one aggregate) and turns the counts into
log-odds, in thousandths.  A token is a noun if the prior and the weights of all
five descriptions add up to more than 0.  Scoring joins tokens with the weights,
so it needs neither a Python worker nor a shuffle of the texts while the weights
are small enough for Spark to broadcast them, and still runs when they are not.

``SEED`` holds hand-marked sentences to start from; any table of marked tokens
(word, prev, next, noun) trains the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hand-marked sentences: /n follows a noun.
SEED = """
the paper/n describes a new method/n for query/n processing/n over large graphs/n
we propose an efficient algorithm/n that finds communities/n in social networks/n
our system/n stores the data/n in a distributed database/n and answers queries/n quickly
the results/n show that the approach/n outperforms existing techniques/n by a wide margin/n
in this work/n we study the problem/n of indexing/n high dimensional vectors/n
the authors/n present a survey/n of recent advances/n in machine/n learning/n
a user/n can easily search the collection/n with keywords/n and filters/n
the performance/n of the model/n depends on the quality/n of the training/n data/n
they introduced a language/n for describing complex events/n in streams/n
experiments/n on real datasets/n confirm the accuracy/n and the speed/n of the solution/n
this article/n discusses the design/n and the implementation/n of a storage/n engine/n
it is difficult to compare these measures/n without a common benchmark/n
large companies/n often collect personal information/n about their customers/n
the server/n sends a message/n to each client/n and then waits for an answer/n
we evaluate the framework/n using several applications/n from biology/n and medicine/n
an index/n reduces the cost/n of a lookup/n but increases the time/n of an update/n
natural language/n understanding/n requires knowledge/n about the world/n
the proposed architecture/n is scalable robust and highly available
researchers/n have recently developed neural networks/n for image/n recognition/n
the government/n must quickly improve the education/n of young children/n
a good teacher/n explains every concept/n with a simple example/n
many people/n believe that the economy/n will grow slowly next year/n
the old city/n was famous for its beautiful gardens/n and narrow streets/n
she carefully opened the door/n and saw a strange light/n in the room/n
the company/n released its annual report/n on monday/n
his brother/n usually reads the newspaper/n before breakfast/n
the river/n flows through a deep valley/n between two mountains/n
scientists/n measured the temperature/n of the water/n at different depths/n
security/n is an important issue/n when data/n is shared between organizations/n
we then extend the theory/n to directed graphs/n with weighted edges/n
the optimizer/n chooses a plan/n according to estimated costs/n and statistics/n
parallel execution/n significantly improves throughput/n on modern hardware/n
to solve this task/n we combine a classifier/n with a set/n of manual rules/n
the community/n has adopted several standards/n for the exchange/n of metadata/n
users/n prefer simple interfaces/n because they are easy to learn
the analysis/n reveals a strong correlation/n between income/n and health/n
a transaction/n either commits all its changes/n or leaves the state/n untouched
most existing approaches/n ignore the structure/n of the documents/n
we describe how the tool/n automatically detects errors/n in programs/n
the evaluation/n was conducted by independent reviewers/n over a period/n of three months/n
these findings/n suggest that better management/n can reduce the risk/n of failure/n
the conference/n attracted numerous participants/n from industry/n and universities/n
traditional databases/n cannot efficiently handle the growing volume/n of sensor/n readings/n
we formally define the semantics/n of the operators/n and prove their correctness/n
such workloads/n are typical of cloud/n environments/n and data/n centers/n
in addition/n the software/n provides visual summaries/n of the selected records/n
"""

KINDS = ("word", "end3", "end2", "prev", "next")


def seed_tokens(text: str = SEED) -> list[tuple[str, str, str, bool]]:
    """(word, prev, next, noun) of marked sentences, one a line."""
    out = []
    for line in text.strip().splitlines():
        marked = line.split()
        words = ["", *(m.removesuffix("/n") for m in marked), ""]
        out += [(words[i + 1], words[i], words[i + 2], m.endswith("/n")) for i, m in enumerate(marked)]
    return out


def seed_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(seed_tokens(), "word string, prev string, next string, noun boolean")


def _described(word: str = "word", before: str = "prev", after: str = "next") -> dict[str, Column]:
    return {"word": F.col(word), "end3": F.right(F.col(word), F.lit(3)), "end2": F.right(F.col(word), F.lit(2)),
            "prev": F.col(before), "next": F.col(after)}


def train(marked: DataFrame, min_count: int = 2) -> DataFrame:
    """(kind, value, weight): log-odds of a noun in thousandths, for values seen `min_count` times.

    Kind ``prior`` is the log-odds without any description.  An empty table gives an empty one.
    """
    pairs = [F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in _described().items()]
    pairs.append(F.struct(F.lit("prior").alias("kind"), F.lit("").alias("value")))
    counts = (marked.select("noun", F.inline(F.array(*pairs))).groupBy("kind", "value")
              .agg(F.count_if("noun").alias("nouns"), F.count_if(~F.col("noun")).alias("others")))
    odds = F.log((2 * F.col("nouns") + 1) / (2 * F.col("others") + 1)) * 1000
    weighed = counts.where(F.col("nouns") + F.col("others") >= min_count).select(
        "kind", "value", F.round(odds).cast("long").alias("odds"))
    prior = weighed.where("kind = 'prior'").agg(F.coalesce(F.max("odds"), F.lit(0))).first()[0]
    return weighed.select("kind", "value", F.when(F.col("kind") == "prior", F.col("odds"))
                          .otherwise(F.col("odds") - prior).alias("weight"))


def neighbours(words: Column) -> Column:
    """Array of (term, prev, next) of an array of words; the empty word stands before the first and after the last."""
    n = F.size(words)
    none = F.array(F.lit(""))
    before = F.slice(F.concat(none, words), 1, n)
    after = F.slice(F.concat(words, none), 2, n)
    return F.arrays_zip(words.alias("term"), before.alias("prev"), after.alias("next"))


def only_nouns(tokens: DataFrame, weights: DataFrame, word: str = "term", before: str = "prev",
               after: str = "next") -> DataFrame:
    """The tokens marked as nouns; words of digits alone never are."""
    out = tokens
    for kind, value in _described(word, before, after).items():
        table = weights.where(F.col("kind") == kind).select(
            F.col("value").alias(f"_{kind}"), F.col("weight").alias(f"_{kind}_w"))
        out = out.join(table, value == F.col(f"_{kind}"), "left").drop(f"_{kind}")
    prior = weights.where("kind = 'prior'").agg(F.coalesce(F.max("weight"), F.lit(0))).first()[0]
    score = sum((F.coalesce(f"_{kind}_w", F.lit(0)) for kind in KINDS), F.lit(prior))
    return out.where((score > 0) & ~F.col(word).rlike("^[0-9]+$")).select(*tokens.columns)
