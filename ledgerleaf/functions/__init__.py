"""Column functions: all stay inside the JVM but for the similarity of Ratcliff and Obershelp."""
