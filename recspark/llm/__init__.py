"""Operators for preparing training text: deduplication, decontamination,
language identification, licence scans, token counts, packing and archives.

Nothing else in the library imports this subpackage; its registered queries
are in ``queries``.
"""
