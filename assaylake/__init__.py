"""Assaylake: a layered transaction lake (bronze, silver, gold) built on Spark DataFrames."""
