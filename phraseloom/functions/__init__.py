"""Column functions: text normalisation, lexicons, rules, scores and similarity measures. Python runs in Arrow batches in
``similarity.sequence_ratio`` and, for texts that are no JSON, in ``text.json_repaired``; everything else stays in the JVM."""
