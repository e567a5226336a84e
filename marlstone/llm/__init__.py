"""Training-data operators: ten corpus-scale transformations over documents,
pages and embeddings. Nothing outside this subpackage imports it."""
