"""Small invented texts of the tests."""

OFFER = """Quotation No: Q24W10132R3
Date: 05.06.2025
To
Kind Attention: Mr. A. Sample
Blue Harbour Works
Subject: Offer for analysers
Sr No
Description
Qty
Unit Price
Total Price
1
Gas analyser
Make: FERROX
Model: GX 20
2 Nos
10,000
20,000
2
Sample pump
150
Meters
Included
5,500/-
Note:
1. Prices are firm
2. Freight is extra
3
Spare filter
Grand Total
25,500
"""
