"""Registered queries, each with the SQL that must give the same rows where SQL can say it."""
