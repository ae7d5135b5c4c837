"""Late-delivery classifiers with Spark ML: split, preparation, training, evaluation, scoring."""
