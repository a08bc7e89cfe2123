"""Spark-first labelling and evaluation of bridge point clouds."""
