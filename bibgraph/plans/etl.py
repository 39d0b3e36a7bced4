"""The paper-processing pipeline of the reference as one chain of DataFrame steps.

raw papers + raw authors + city list + review texts  ->  three load-file
tables (Conference / Journal / Workshop) with the list columns as text,
ready for ``sources.load_files.write_load_files`` and the graph builders.

Order of steps as in the reference: clean -> authors -> corresponding author
-> location -> approval -> categorise -> reviewers and review texts ->
proceedings / edition -> journal name and renames -> keywords -> citations
-> split by type -> previous-edition conference copies.  Every list built
here is bounded by its draw count (reviewers and texts <= 3, keywords <= 5,
citations <= 50) except the author list, which is the file format's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, synth
from ..operators.keywords import extract_keywords
from ..session import written


def _ranked_list(picks: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): the picked values of each key in rank order."""
    return (picks.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct("rank", value))).alias("_l"))
            .select(key, F.col(f"_l.{value}").alias(name)))


def process_papers(raw_papers: DataFrame, raw_authors: DataFrame, cities: DataFrame,
                   review_texts: DataFrame, n_keywords: int = 4,
                   generations: int = 1, nouns: DataFrame | None = None) -> dict[str, DataFrame]:
    """Load-file tables keyed Conference / Journal / Workshop.

    ``cities(location)``, ``review_texts(review_id, Text)``; ``raw_authors``
    has (paperId, authorId, position).  Random choices are seeded hash
    draws (see ``operators.synth``).  ``nouns``: weights of ``operators.nouns``
    that keep only nouns as keywords.
    """
    # read five times below (corresponding authors, reviewers, their pool, own papers, lists)
    raw_authors = written(raw_authors.select("paperId", "authorId", "position"), "authors")
    raw_papers = clean.dedupe_papers(raw_papers)
    papers = clean.clean_papers(raw_papers)
    papers = clean.aggregate_paper_authors(papers, raw_authors).drop("n_authors", "last_author")
    papers = synth.pick_one(papers, "paperId", cities.select("location"), "location", seed="loc")
    papers = papers.withColumn("approved", F.lit("Y"))
    papers = clean.categorize_publication(papers)
    # read four times below (reviewers, texts, keywords, final joins): cut here once
    papers = written(synth.number_of_reviewers(papers), "papers")

    # reviewers: any author of any kept paper except the paper's own authors
    own = raw_authors.where(F.col("authorId").isNotNull()).select("paperId", "authorId")
    pool = own.join(papers.select("paperId"), "paperId", "left_semi").select("authorId")
    reviewers = synth.pick_from_pool(papers.select("paperId", "number_reviewers"), "paperId",
                                     "number_reviewers", pool, "authorId", seed="rev",
                                     exclude=own)
    texts = synth.pick_from_pool(papers.select("paperId", "number_reviewers"), "paperId",
                                 "number_reviewers", review_texts.select("review_id"),
                                 "review_id", seed="comment")
    texts = texts.join(review_texts.select(F.col("review_id").alias("pick"), "Text"), "pick")

    papers = clean.extract_edition(clean.venue_names(papers))
    papers = (papers.drop("venue", "journal_name")
              .withColumnRenamed("journal", "journal_name")
              .withColumnRenamed("location", "venue"))

    # keywords of the abstract (field term forced in), then the field term appended
    kws = extract_keywords(papers.select("paperId", F.col("abstract").alias("text"),
                                         "field_query"),
                           key="paperId", text="text", field="field_query", n=n_keywords, nouns=nouns)
    papers = (papers.join(_ranked_list(kws, "paperId", "term", "keywords"), "paperId")
              .transform(clean.finalize_keywords))

    # citations: 15..50 distinct other papers of the whole fetched set
    rows = synth.number_of_citations(raw_papers.select("paperId"))
    cites = synth.pick_from_pool(rows, "paperId", "synthetic_cites", raw_papers.select("paperId"),
                                 "paperId", seed="cite", slack=40, self_excluded=True)

    papers = (papers
              .join(clean.author_id_lists(raw_authors), "paperId")
              .join(_ranked_list(reviewers, "paperId", "pick", "reviewers"), "paperId", "left")
              .join(_ranked_list(texts, "paperId", "Text", "comments"), "paperId", "left")
              .join(_ranked_list(cites, "paperId", "pick", "Citations"), "paperId"))
    # each type is a selection of the same rows, and conferences are read twice
    papers = written(clean.list_columns_to_strings(papers), "processed")
    parts = clean.split_by_type(papers)
    return {"Conference": clean.clone_previous_edition(parts["Conference"], generations),
            "Journal": parts["JournalArticle"],
            "Workshop": parts["Workshop"]}
