"""Operators for preparing training corpora: near-duplicates, classifiers, language models, tokens, mixing."""
