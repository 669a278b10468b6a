"""Training-data operators: quality, deduplication, decontamination, privacy, licences and token output.

Nothing else in the package imports this subpackage.
"""
