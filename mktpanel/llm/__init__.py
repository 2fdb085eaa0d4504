"""Training-data operators: quality, search, language, deduplication, licences,
mixing, packing, token files, web-archive records.  Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it."""
