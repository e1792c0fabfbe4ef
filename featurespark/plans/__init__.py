"""Registered queries, their SQL, and catalog DDL."""
