"""Jobs over typed facts: change capture, as-of reads, aggregates, series, profiles, quality, samples, models."""
