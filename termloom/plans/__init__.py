from termloom.plans.tfidf import Index, build_index, corpus_tfidf

__all__ = ["Index", "build_index", "corpus_tfidf"]
