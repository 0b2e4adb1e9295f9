"""Reading and writing of corpora, dictionaries and vocabularies. Paths may have any Hadoop URI scheme."""
