"""
versions, lines, people, stage, rejects, guarantee, fact, employees."""
