"""Training-data operators: quality, rules, language models, language ID,
packing, BPE, HTML extraction, fingerprints and near-duplicates.

One module per operator; ``registry`` has the registered queries and their SQL.
Nothing else in the library imports this subpackage.
"""
