"""tessera: Spark-native text and trip analytics.

Batch jobs written with the DataFrame API:

* text  -- tokenising, word counts, vocabulary, document frequency,
  inverted index, one-word and all-words search with tf ranking;
* trips -- two schema eras of trip Parquet unified into one table
  partitioned by (anio, mes), and the analytical queries over it;
* corpus / files -- generating, numbering and replicating corpora, and
  file-level bookkeeping (era routing, expected months, inventories).
"""

__version__ = "0.1.0"
