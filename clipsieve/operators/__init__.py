"""The stages: evidence, lexicon scores, entities, embeddings, clusters, profiles, gates and cards."""
