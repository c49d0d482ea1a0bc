"""Operators of a large training-data pipeline, each by its own method.

=====================  =====================================================================
``id_codec``           token ids in Simple-8b words (op1)
``url_filter``         host rules, then trust and distrust over the link graph (op2)
``langid``             language spans by Viterbi over per-word scores (op3)
``pseudo_lm``          masked pseudo-likelihood from a bidirectional window network (op4)
``site_lines``         site-relative line frequency (op5)
``line_quality``       quality counts and cross-document line frequency (op6)
``chosen_path``        chosen-path similarity join and its components (op7)
``containment``        size-partitioned MinHash containment search (op8)
``roles``              minimum-cost role repair of conversations (op9)
``prefix_bpe``         byte-pair encoding by a table of prefixes' last tokens (op10)
``vector_codes``       codebook codes of vectors by active-entry Lloyd (op11)
``hard_negatives``     hard negatives by score slots and suffix merges (op12)
``packing``            documents packed into sequences by linear grouping (op13)
``queries``            the ``opN_*`` queries over the test tables and their DuckDB texts
=====================  =====================================================================

Nothing else in the library imports this subpackage.
"""
