from conftest_llm import edge_docs, edge_rows, empty_docs  # noqa: F401
