"""Training-data operators: fingerprints, URL filters, near-duplicate joins,
fixity audits, language identification, secret and personal-data scans,
mixing, decontamination and quality grading.

Nothing else in the library imports this subpackage. ``llm.queries`` holds the
registered queries and their SQL.
"""
