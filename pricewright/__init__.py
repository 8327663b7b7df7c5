"""Product-price datasets on Spark: clean, de-duplicate, sample, split, prompt, model, score."""
