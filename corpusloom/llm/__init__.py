"""Operators for preparing training data at large scale: deduplication, decontamination,
filters, chat formatting, packing and token files. `queries.QUERIES` names one query per operator."""
