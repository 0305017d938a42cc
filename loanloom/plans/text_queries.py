"""Text features, retrieval, assembly."""

from pyspark.sql import functions as F

from loanloom.operators import documents
from loanloom.plans.catalog import query
from loanloom.plans.profile_queries import rounded
from loanloom.sources.tables import table


@query("text_components")
def text_components(spark, folder):
    return rounded(documents.text_components(table(spark, folder, "documents"), "text", "doc_id"))


QUESTION = "the data and terms"


@query("retrieve_documents", f"""
WITH h AS (SELECT doc_id, lang, source, ({' + '.join(f"contains(text, '{w}')::INT" for w in QUESTION.split())})::INT AS n_words FROM documents)
SELECT * FROM h WHERE n_words > 0 ORDER BY n_words DESC, doc_id LIMIT 10""")
def retrieve_documents(spark, folder):
    return documents.retrieve(table(spark, folder, "documents"), "text", "doc_id", QUESTION, 10).select("doc_id", "lang", "source", "n_words")


@query("numbered_articles", """
SELECT source, pos, '[' || pos || '] ' || lang || chr(10) || text AS article FROM
  (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM documents)""")
def numbered_articles(spark, folder):
    return documents.numbered_articles(table(spark, folder, "documents"), "source", "doc_id", "lang", "text")
