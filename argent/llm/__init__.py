"""Training-data operators: cleaning, near-duplicate removal, language-model
scoring, mixing and token accounting. Nothing else in the library imports this
package."""
