"""Queries with their oracle SQL, and landed payloads derived from tables to feed the scans."""
