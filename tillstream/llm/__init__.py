"""Operators of a training-data pipeline: packing, deduplication, language
identification, filters, licence scans, decontamination and token files.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator. Nothing else in the library imports this
package.
"""
