"""DataFrame -> DataFrame steps; those that parse or project run on batch and stream alike."""
