"""Query of the web pages."""

from __future__ import annotations

from lakesift.llm.common import query, table
from lakesift.llm.pagetext import page_texts


@query("op5_text_density")
def op5(spark, folder):
    """The main text of every page."""
    return page_texts(table(spark, folder, "pages"))
