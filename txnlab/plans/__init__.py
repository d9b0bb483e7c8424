"""Plans: the library's operators composed into the queries users run."""
