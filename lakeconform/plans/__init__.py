"""Entity pipelines, curated datasets, analyst queries, gates and the run itself."""
