"""Training-data operators over the documents, pages, benchmark, labels and conversations tables."""
