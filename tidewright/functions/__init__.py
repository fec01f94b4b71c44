"""Column functions: text cleaning, parsing, codes, classifiers. All are Column -> Column and stay in the JVM."""
