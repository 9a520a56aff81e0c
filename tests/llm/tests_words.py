WORDS = [a + b for a in "ba ke li mo nu sa te vi xo zu".split() for b in "ran del fis gop hum jat".split()]
